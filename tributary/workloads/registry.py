"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is ``fn(spark, sf_dir) -> DataFrame``; most have an oracle SQL
text that DuckDB runs over the same parquet tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.fixtures import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, ctes: tuple = ()):
    """Register a query; ``sql`` gets the fixture views it uses as CTEs."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *ctes)
        return fn
    return deco
