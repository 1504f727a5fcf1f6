"""All queries of this subpackage with their DuckDB equivalents."""

from __future__ import annotations

from pagemill.llm import leaks_queries, looks_queries, packing_queries, personal_queries, quality_queries, scans_queries, split_queries

_MODULES = (split_queries, looks_queries, quality_queries, packing_queries, leaks_queries, personal_queries, scans_queries)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
