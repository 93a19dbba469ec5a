"""Registry-style table updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.plans.strategy import cut_lineage


def apply_dead_letter(jobs: DataFrame, commands: DataFrame) -> DataFrame:
    """Dead-letter commands on discarded jobs: ``retry`` makes the job
    ``available`` again (attempt kept, error cleared), ``discard`` removes
    it. Commands on other jobs have no effect. Latest command per job wins."""
    cmd = commands.groupBy("job_id").agg(F.max_by("op", "seq").alias("_op"))
    j = jobs.join(cmd, "job_id", "left")
    dead = F.col("state") == "discarded"
    j = j.filter(~(dead & (F.coalesce(F.col("_op"), F.lit("")) == "discard")))
    retry = dead & (F.col("_op") == "retry")
    out = j.withColumn("state", F.when(retry, F.lit("available")).otherwise(F.col("state")))
    if "error" in jobs.columns:
        out = out.withColumn("error", F.when(retry, F.lit(None)).otherwise(F.col("error")))
    return out.drop("_op")


def compact_registry(log: DataFrame, key: str = "key", order: str = "seq", op: str = "op") -> DataFrame:
    """Registry state from a register/delete log: the last write per key
    wins and a delete removes the entry (one partial aggregate per key)."""
    payload = [c for c in log.columns if c not in (key,)]
    last = log.groupBy(key).agg(F.max_by(F.struct(*payload), order).alias("_last"))
    return last.filter(F.col(f"_last.{op}") != "delete").select(key, "_last.*").drop(op)


def materialise_jobs(requests: DataFrame, prefix: str = "fake-", order: list[str] | None = None,
                     width: int = 6) -> DataFrame:
    """Turn requests into job rows with sequential ids
    ``<prefix><n:06d>`` in request order, default queue, state
    ``available`` and attempt 0.

    Ids without a global window: the rows are range-partitioned on the order
    columns, sorted and written to the shared checkpoint folder, which fixes
    the order; a row's number is the count of all earlier partitions (one row
    each) and its place in its own, which Spark's row counter gives.
    """
    order = order or ["created_at", "request_id"]
    ranged = requests.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        F.col("_pid").alias("_p"), F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    numbered = ranked.withColumn("_i", place).join(F.broadcast(offsets), F.col("_pid") == F.col("_p"))
    numbered = numbered.withColumn("_n", F.col("_before") + F.col("_i"))
    return numbered.select(
        *[c for c in requests.columns if c not in ("queue",)],
        F.format_string(f"{prefix}%0{width}d", F.col("_n")).alias("id"),
        F.coalesce(F.nullif(F.col("queue"), F.lit("")), F.lit(K.DEFAULT_QUEUE)).alias("queue"),
        F.lit("available").alias("state"), F.lit(0).alias("attempt"), F.lit(3).alias("max_attempts"))
