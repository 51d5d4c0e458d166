"""Names of the registered queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from . import oracles, queries

QUERIES = {name: getattr(queries, name) for name in dir(queries) if name.startswith("op")}
ORACLES = {name: getattr(oracles, name.upper()) for name in QUERIES if hasattr(oracles, name.upper())}
