"""Query catalog: every operator as a query over the driver tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``; the names are
shared so result columns can be compared one to one. Operators whose result is not a
SQL-expressible function of the tables (Python workers, streaming) have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tokenloom.plans import (  # noqa: F401
        queries_core, queries_dist, queries_io, queries_order, queries_store, queries_text, queries_tokens, queries_vectors)
