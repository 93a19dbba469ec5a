"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 65,536 points. Every shard owns ``virtual`` of them by hash, and
a row's key falls on one; the row belongs to the next owner clockwise. A shard
takes no more than its capacity: what overflows continues clockwise to the
next shard with room. With no slack the capacities add up to the rows, so the
counts are at most one apart; with slack, a change of the number of shards
moves fewer rows.

Rows are counted by point in Spark; the owners' intervals of each point's rows
follow from those counts (at most 65,536 numbers, whatever the input) and are
joined back. All of it is SQL functions, joins and windows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.plans.strategy import cut_lineage

POINTS = 1 << 16


def _point(*cols):
    return F.shiftrightunsigned(F.xxhash64(*cols), 48).cast("int")


def owners(spark, shards: int, virtual: int) -> list[int]:
    """Of each point, the index in the clockwise list of nodes of its owner;
    and that list's shards. Nodes on one point: the smaller shard is first."""
    shard, copy = (F.col("id") / virtual).cast("int"), F.col("id") % virtual
    nodes = spark.range(shards * virtual).select(shard.alias("s"), _point(F.lit("node"), shard, copy).alias("p"))
    ring = sorted((r.p, r.s) for r in nodes.collect())
    first, k = [], 0
    for p in range(POINTS):
        while k < len(ring) and ring[k][0] < p:
            k += 1
        first.append(k % len(ring))
    return first, [s for _, s in ring]


def intervals(counts: dict, first: list, ring: list, shards: int, slack: float) -> list[tuple]:
    """(point, from, to, shard, slot): which of a point's rows, by rank, go to
    which shard, and the slot of the first of them."""
    total = sum(counts.values())
    if slack:
        room = [int(-(-total * (1 + slack) // shards))] * shards
    else:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    out, over = [], []

    def take(point, rank, n, shard):
        got = min(n, room[shard] - filled[shard])
        if got:
            out.append((point, rank, rank + got, shard, filled[shard]))
            filled[shard] += got
        return got

    for p in sorted(counts):
        got = take(p, 0, counts[p], ring[first[p]])
        if got < counts[p]:
            over.append((p, got))
    for p, rank in over:
        k = first[p]
        while rank < counts[p]:
            k = (k + 1) % len(ring)
            rank += take(p, rank, counts[p] - rank, ring[k])
    return out


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, virtual: int = 128, slack: float = 0.0) -> DataFrame:
    """Per row: ``id_col``, size (UTF-8 bytes and 1), text_crc32, shard, slot.

    Equal rows are counted together before they are dealt out, so that one
    repeated row fills no task. Null ids have a place on the ring like any
    other; null texts are empty. No rows give no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.groupBy(id_col, "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    rows = cut_lineage(rows.withColumn("_point", _point(F.lit("key"), F.col(id_col).cast("string"))))
    counts = {r["_point"]: r["n"] for r in rows.groupBy("_point").agg(F.sum("_n").alias("n")).collect()}
    first, ring = owners(spark, shards, virtual)
    parts = json.dumps([dict(zip(("_p", "_from", "_to", "shard", "_slot"), i)) for i in intervals(counts, first, ring, shards, slack)])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(parts), "array<struct<_p int, _from long, _to long, shard int, _slot long>>")))
    before = Window.partitionBy("_point").orderBy(F.xxhash64(F.col(id_col).cast("string"), "size", "text_crc32"), id_col, "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_rank", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).withColumn("_rank", F.col("_rank") + F.col("_copy"))
    here = (F.col("_point") == F.col("_p")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    # at most an interval for each point and shard border
    placed = ranked.join(F.broadcast(table), here)
    return placed.select(id_col, "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))
