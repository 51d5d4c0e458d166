"""The registered queries (name -> callable) and their DuckDB statements."""

from __future__ import annotations

from . import entities, oracles, store, web

QUERIES = entities.QUERIES | web.QUERIES | store.QUERIES
ORACLES = {name: getattr(oracles, name.upper()) for name in QUERIES if hasattr(oracles, name.upper())} | store.ORACLES
