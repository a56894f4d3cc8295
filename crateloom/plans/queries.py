"""The queries of the core and their SQL."""

from __future__ import annotations

from crateloom.plans import graph_queries, orphan_queries, packed_queries, page_queries, reconcile_queries, reference_queries, stream_queries

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _module in (orphan_queries, packed_queries, reference_queries, graph_queries, page_queries, reconcile_queries, stream_queries):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
