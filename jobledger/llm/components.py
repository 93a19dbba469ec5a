"""Connected components of an edge table by alternating stars.

Each round points every node at the smallest node that it can see (large star,
then small star); the rounds end when the edges no longer change. A round is
joins and partial minima, so that a node with very many edges is split by the
skewed-join rule and never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.plans.strategy import cut_lineage


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).unionByName(rest).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: two columns of one ordered type. Returns (node, root) for
    every node but the roots themselves; root: the component's smallest node.
    Self-links, repeated and null rows do no harm; no edges give no rows."""
    a, b = edges.columns[:2]
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now, mark = cut_lineage(pairs), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == mark or not state.n:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (state.n, state.h)
        now = cut_lineage(_small(_large(now)))
