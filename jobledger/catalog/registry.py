"""Registry of named queries: the Spark job and, where SQL can say it, its
DuckDB oracle over the same parquet tables (fixture views as CTEs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobledger.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the oracle body; ``views`` lists the fixture views it reads.
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(list(views), sql) if views else sql
        return fn
    return deco
