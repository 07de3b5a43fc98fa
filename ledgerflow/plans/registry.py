"""Registry of named queries: a Spark builder and (where SQL can say it) an
independent DuckDB oracle per name.

Spark builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the
driver tables of that directory.  Oracles are single SQL statements that
DuckDB runs on the same tables (registered as views by the caller).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from ledgerflow.plans import (queries_alloc, queries_grid, queries_io, queries_posting,  # noqa: F401
                                  queries_templates)
