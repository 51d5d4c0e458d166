"""Operators for preparing training corpora: filtering, scoring, matching, mixing and sharding."""
