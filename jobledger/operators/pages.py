"""Pages over an ordered table (L1, L2).

``orderBy().offset().limit()`` plans as a distributed top-(offset+limit)
(TakeOrderedAndProject), so only ``offset + limit`` rows per partition move;
the page metadata is one lazy global count, not a driver-side action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def paginate(df: DataFrame, order: list[Column | str], limit: int, offset: int = 0
             ) -> tuple[DataFrame, DataFrame]:
    """L1: ``(page, meta)``; meta is one row ``total, limit, offset, has_more``
    with ``has_more = offset + returned < total``. ``order`` must be total
    (end it with a unique key) for stable pages."""
    page = df.orderBy(*order).offset(offset).limit(limit)
    total = F.count(F.lit(1))
    meta = df.agg(total.alias("total")).select(
        "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"),
        (F.lit(offset) + F.least(F.lit(limit), F.greatest(F.col("total") - offset, F.lit(0))) < F.col("total"))
        .alias("has_more"))
    return page, meta


def page_after(df: DataFrame, keys: list[tuple[str, bool]], limit: int, after: dict | None = None) -> DataFrame:
    """L1 by key: the ``limit`` rows that follow the row ``after`` (its values
    of the key columns; none: the first page). ``keys``: (column, descending),
    ending with a unique one; NULLs come last. However deep the page, only
    ``limit`` rows per partition move, and the first key's bound is a filter
    that reaches the scan."""
    order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in keys]
    if after is not None:
        beyond, same = F.lit(False), F.lit(True)
        for c, down in keys:
            v = after[c]
            if v is None:  # nothing follows a NULL but other NULLs
                later = F.lit(False)
            else:
                later = F.col(c).isNull() | (F.col(c) < F.lit(v) if down else F.col(c) > F.lit(v))
            beyond = beyond | (same & later)
            same = same & F.col(c).eqNullSafe(F.lit(v))
        df = df.filter(beyond)
    return df.orderBy(*order).limit(limit)


def _page_keys(keys: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in keys]


def write_pages(df: DataFrame, keys: list[tuple[str, bool]], path: str) -> DataFrame:
    """L1 by rank, once a table: its rows in slices of about equally many that
    follow one another in the order of ``keys`` ((column, descending), ending
    with a unique one; NULLs last), a folder a slice below ``path`` (shared
    storage). The result is the table read back, for ``page_at``."""
    ranged = df.repartitionByRange(*_page_keys(keys)).sortWithinPartitions(*_page_keys(keys))
    sliced = ranged.withColumn("_slice", F.spark_partition_id())
    sliced.write.mode("overwrite").partitionBy("_slice").parquet(path)
    return df.sparkSession.read.schema(sliced.schema).parquet(path)


def page_at(pages: DataFrame, keys: list[tuple[str, bool]], limit: int, offset: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a table that ``write_pages``
    wrote. The slices' counts (footers only; one row a slice) say which slices
    hold them, and only these folders are read, so a page deep in the table
    costs what the first one does. Beyond the end the page is empty."""
    before, hit, skip = 0, [], 0
    for s, n in sorted((r["_slice"], r["count"]) for r in pages.groupBy("_slice").count().collect()):
        if before < offset + limit and before + n > offset:
            skip = skip if hit else offset - before
            hit.append(s)
        before += n
    return pages.filter(F.col("_slice").isin(hit)).orderBy(*_page_keys(keys)).offset(skip).limit(limit).drop("_slice")


def list_dead_letter(jobs: DataFrame, queue: str | None = None, limit: int = 50, offset: int = 0,
                     id_col: str = "job_id") -> tuple[DataFrame, DataFrame]:
    """L2: discarded jobs (optionally of one queue), newest discard first."""
    dead = jobs.filter(F.col("state") == "discarded")
    if queue:
        dead = dead.filter(F.col("queue") == queue)
    return paginate(dead, [F.col("discarded_at").desc_nulls_last(), F.col(id_col)], limit, offset)
