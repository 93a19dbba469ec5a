"""Tables played back as streams, and streams run to their end.

``arrive`` writes a table's rows as the files of a stream: by and large in
event-time order, each row some time late, and a last row far
ahead that lets the watermark close what is still open. ``run`` writes a
stream's epochs below a path, an epoch again over itself if it is replayed,
until all files are read, and gives the rows back with their ``epoch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.session import checkpoint_dir

FILES = 4  # that a batch of the stream reads at most


def folder(spark, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def arrive(rows: DataFrame, path: str, time_col: str, batches: int = 5, late_s: int = 86_400, last: dict | None = None) -> DataFrame:
    """Write ``rows`` below ``path`` in ``batches`` parts of equal time, each
    row delayed by up to ``late_s`` seconds (by its hash), then one closing row: any row
    with the columns in ``last`` replaced and a time ten years after all
    others. The stream of these files, in the order of their writing. Rows
    without a time come first."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[time_col]
    t = F.col(time_col).cast("timestamp")
    low, high = rows.agg(F.min(t).cast("double"), F.max(t).cast("double")).first()
    if low is not None:
        delay = F.pmod(F.xxhash64(*rows.columns), F.lit(1_000_000)) / 1_000_000 * late_s
        part = F.coalesce(F.floor((t.cast("double") + delay - low) / max(high - low, 1) * batches), F.lit(0))
        dealt = rows.withColumn("_part", F.least(part, F.lit(batches - 1)))
        for i in range(batches):
            dealt.filter(F.col("_part") == i).drop("_part").repartition(FILES).write.mode("append").parquet(path)
        end = rows.filter(t.isNotNull()).limit(1).withColumn(time_col, (F.timestamp_seconds(F.lit(high)) + F.expr("INTERVAL 10 YEAR")).cast(kind))
        for name, value in (last or {}).items():
            end = end.withColumn(name, F.lit(value).cast(dict(rows.dtypes)[name]))
        end.write.mode("append").parquet(path)
    else:
        rows.write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def start(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Start writing each epoch of ``stream`` to ``path/epoch=<id>``, over what
    an earlier attempt at the epoch left there; stops when all input is read."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run ``stream`` to its end; all epochs' rows with ``epoch``."""
    spark = stream.sparkSession
    query = start(stream, f"{path}/out", f"{path}/checkpoint", mode)
    query.awaitTermination()
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("epoch", T.LongType())])).parquet(f"{path}/out")
