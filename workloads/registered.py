"""All registered queries and their DuckDB counterparts."""

from __future__ import annotations

from workloads import (
    coding_queries,
    comparison_queries,
    io_queries,
    page_queries,
    registry_queries,
    text_queries,
)

_GROUPS = (coding_queries, page_queries, registry_queries, text_queries, comparison_queries, io_queries)

QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
