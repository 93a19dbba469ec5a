"""Driver tables: one parquet file per table, read lazily.

Reads are plain ``spark.read.parquet``; Catalyst prunes columns and pushes
filters into the scan, so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobledger.session import ensure_conf

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    ensure_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
