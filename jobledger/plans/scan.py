"""Ordered folds per key that do not put a whole key into one task.

A running aggregate over ``Window.partitionBy(key).orderBy(...)`` sends every
row of a key to one task. Here rows are first range-partitioned on
(key, order), so slices hold about equally many rows whatever the clocks or
keys look like: a small key lies in one slice, a hot one runs through many,
and a burst at one instant is parted by the last order columns. The slices
are written to the shared checkpoint folder, which fixes them for all later
steps (a range partitioning computed twice need not agree with itself).

1. ``slices`` adds the slice number ``_bk``;
2. per (key, slice) totals are aggregated, and a window over them gives the
   fold of all earlier slices of the key. Only the first key of a slice can
   have earlier slices, so this is at most one row per slice;
3. the fold inside each (key, slice) is a window of its own, seeded with that
   row.

Only associative folds are offered: ``sum`` and ``max`` (``max`` of a struct
ordered by its leading fields gives "latest non-null value"). NULL keys are a
key of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.plans.strategy import cut_lineage

SLICE = "_bk"


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def slices(df: DataFrame, key, order: list[str], ordered: bool = False) -> DataFrame:
    """Rows with their slice number ``_bk``, which rises with (key, order).
    ``order`` should end with a column that tells equal times apart. With
    ``ordered``, a slice's rows are written in order, once for all readers."""
    ranged = df.repartitionByRange(*_keys(key), *order)
    if ordered:
        ranged = ranged.sortWithinPartitions(*_keys(key), *order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def _carry(df: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Join at most one row per slice back on (key, slice)."""
    other = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(SLICE).alias("_kb"), "_carry")
    cond = F.col(SLICE) == F.col("_kb")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(F.broadcast(other), cond, "left").drop("_kb", *[f"_k{i}" for i in range(len(keys))])


def running(df: DataFrame, key, order: list[str], value: Column, out: str, how: str = "sum", inclusive: bool = True) -> DataFrame:
    """Add ``out`` = running ``how`` (sum|max) of ``value`` per ``key`` in
    ``order`` (including the current row unless ``inclusive=False``). ``key``
    may be None for a global fold. Slices that ``df`` already has (column
    ``_bk``, made for the same key and order) are used and kept."""
    keys = _keys(key)
    agg = F.sum if how == "sum" else F.max
    own = SLICE not in df.columns
    b = (slices(df, key, order) if own else df).withColumn("_v", value)
    totals = b.groupBy(*keys, SLICE).agg(agg("_v").alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_carry", agg("_t").over(earlier)).filter(F.col("_carry").isNotNull())
    j = _carry(b, carried, keys)
    inner = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = agg("_v").over(inner)
    if how == "sum":
        combined = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(local, F.lit(0))
    else:
        combined = F.greatest(F.col("_carry"), local)  # greatest skips NULLs
    res = j.withColumn(out, combined).drop("_v", "_carry")
    return res.drop(SLICE) if own else res


def next_row(df: DataFrame, key, order: list[str], fields: list[str], prefix: str = "next_") -> DataFrame:
    """Add ``next_<f>`` = value of ``f`` on the next row of the same key in
    ``order``: ``lead`` within the slice, and for a slice's last row the first
    row of the key's next slice."""
    keys = _keys(key)
    own = SLICE not in df.columns
    b = slices(df, key, order) if own else df
    rec = F.struct(*order, *[F.col(f).alias(f"_f_{f}") for f in fields])
    firsts = b.groupBy(*keys, SLICE).agg(F.min(rec).alias("_first"))
    later = Window.partitionBy(*keys).orderBy(SLICE)
    carried = firsts.withColumn("_carry", F.lead("_first").over(later)).filter(F.col("_carry").isNotNull())
    j = _carry(b, carried, keys)
    inner = Window.partitionBy(*keys, SLICE).orderBy(*order)
    j = j.withColumn("_next", F.coalesce(F.lead(rec).over(inner), F.col("_carry")))
    for f in fields:
        j = j.withColumn(f"{prefix}{f}", F.col("_next").getField(f"_f_{f}"))
    j = j.drop("_next", "_carry")
    return j.drop(SLICE) if own else j
