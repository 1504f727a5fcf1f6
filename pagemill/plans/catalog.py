"""All core queries with their DuckDB equivalents."""

from __future__ import annotations

from pagemill.plans import library, nested_queries, oracles, provider_queries, queries

QUERIES = queries.QUERIES | provider_queries.QUERIES | library.QUERIES | nested_queries.QUERIES
ORACLES = oracles.ORACLES | provider_queries.ORACLES | library.ORACLES | nested_queries.ORACLES
flagship = queries.flagship
