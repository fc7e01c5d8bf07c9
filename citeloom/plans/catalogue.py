"""Every query of the library with its SQL."""

from __future__ import annotations

from . import catalog_queries, corpus_queries, graph_queries, label_queries, paper_queries, workflow_queries  # noqa: F401  they register themselves
from .registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
