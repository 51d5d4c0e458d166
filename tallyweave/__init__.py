"""Spark-native collection, scoring, deduplication and review of entity records."""
