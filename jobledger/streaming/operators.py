"""Streaming forms of ledger operators.

Each function takes a static or a streaming DataFrame and builds the same
plan, so the batch run is the oracle of the stream. Event time is cast to
TIMESTAMP (watermarks need it); results are cast back to TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.functions.validation import request_reason
from jobledger.operators.windows import _event_state


def _interval_seconds(text: str) -> float:
    n, unit = text.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return float(n) * mult


def stream_throughput(events: DataFrame, width: str = "1 hour", slide: str | None = None,
                      watermark: str = "10 minutes", time_col: str = "time") -> DataFrame:
    """Completed / failed job events per event-time window (tumbling or
    sliding). On a stream, events later than the watermark are dropped and
    a window is final once the watermark passes its end."""
    e = events.filter(F.col("type").isin("job.completed", "job.failed")).withColumn(
        "_t", F.col(time_col).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("_t", watermark)
    win = F.window("_t", width, slide) if slide else F.window("_t", width)
    g = e.groupBy(win.alias("w")).agg(
        F.count_if(F.col("type") == "job.completed").alias("completed"),
        F.count_if(F.col("type") == "job.failed").alias("failed"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "completed", "failed",
                    F.round(F.col("completed") / F.lit(_interval_seconds(width)), 6).alias("throughput_per_second"))


def stream_current_state(events: DataFrame, horizon: str = "30 days", watermark: str = "1 day") -> DataFrame:
    """Running current state per job in which terminal states are final:
    the earliest terminal event if the job has one, else its latest event.

    A table is answered by two order-independent aggregates. A stream gives
    the changes of each job's state (``latest.CHANGES``; update mode), from a
    stateful processor: late and out-of-order events within the watermark give
    the answer of the table, and a job's state is dropped once the watermark
    is ``horizon`` past its newest event. Dropping an unfinished job's state
    never changes its answer; an event that follows a terminal one by more
    than the horizon begins the job anew."""
    e = events.withColumn("_state", _event_state()).filter(F.col("_state").isNotNull())
    if events.isStreaming:
        from jobledger.streaming.latest import state_changes

        e = e.select("subject", "event_id", F.col("_state").alias("state"), F.col("time").cast("timestamp").alias("_t"))
        return state_changes(e, int(_interval_seconds(horizon) * 1000), watermark)
    rec = F.struct(F.col("time"), F.col("event_id"), F.col("_state").alias("state"))
    term = F.col("_state").isin(*K.TERMINAL_STATES)
    g = e.groupBy("subject").agg(F.min(F.when(term, rec)).alias("_t"), F.max(F.when(~term, rec)).alias("_o"))
    pick = F.coalesce(F.col("_t"), F.col("_o"))
    return g.select("subject", pick["state"].alias("state"), pick["time"].alias("since"),
                    pick["event_id"].alias("event_id"), F.col("_t").isNotNull().alias("final"))


def stream_worker_sessions(heartbeats: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour",
                           ts_col: str = "ts") -> DataFrame:
    """Worker sessions: heartbeats closer than ``gap`` belong to one
    session; a session ends ``gap`` after its last heartbeat.

    A stream uses ``session_window`` with a watermark. A static table is
    split into sessions by gaps and islands over the sliced scan (a worker
    with a huge share of heartbeats is spread over many tasks): heartbeats
    are first reduced to distinct (worker, time) with counts, a heartbeat
    ends a session when the next one is ``gap`` or more later, and the
    session number is the running count of earlier ends.
    """
    if not heartbeats.isStreaming:
        return _sessions_by_scan(heartbeats, gap, ts_col)
    h = heartbeats.withColumn("_t", F.col(ts_col).cast("timestamp")).withWatermark("_t", watermark)
    return sessions_by_window(h, gap, "_t")


def sessions_by_window(h: DataFrame, gap: str, ts_col: str) -> DataFrame:
    """``session_window`` with the "less than gap" rule: Spark merges two
    heartbeats exactly ``gap`` apart, so the window gap is one microsecond
    shorter (timestamps have microsecond resolution) and the microsecond is
    added back to the session end."""
    gap_us = int(_interval_seconds(gap) * 1_000_000)
    g = h.groupBy("worker_id", F.session_window(ts_col, f"{gap_us - 1} microseconds").alias("s")).agg(
        F.count(F.lit(1)).alias("heartbeats"))
    return g.select("worker_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    (F.col("s.end") + F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz").alias("session_end"),
                    "heartbeats")


def _sessions_by_scan(heartbeats: DataFrame, gap: str, ts_col: str) -> DataFrame:
    from jobledger.functions.timecols import epoch_us
    from jobledger.plans import scan

    gap_us = int(_interval_seconds(gap) * 1_000_000)
    d = heartbeats.groupBy("worker_id", F.col(ts_col).cast("timestamp_ntz").alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"))
    d = scan.next_row(scan.slices(d, "worker_id", ["_t"]), "worker_id", ["_t"], ["_t"])
    ends = (F.col("next__t").isNull() | (epoch_us("next__t") - epoch_us("_t") >= gap_us)).cast("int")
    d = scan.running(d, "worker_id", ["_t"], ends, "_sid", inclusive=False)
    g = d.groupBy("worker_id", "_sid").agg(F.min("_t").alias("session_start"), F.max("_t").alias("_last"),
                                           F.sum("_n").alias("heartbeats"))
    return g.select("worker_id", "session_start",
                    (F.col("_last") + F.make_dt_interval(secs=F.lit(gap_us / 1_000_000))).alias("session_end"),
                    "heartbeats")


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate requests in one pass: (good, bad with ``reason``)."""
    r = requests.withColumn("reason", request_reason("type", "queue"))
    return r.filter(F.col("reason").isNull()).drop("reason"), r.filter(F.col("reason").isNotNull())


def stream_ingest(requests: DataFrame, good_path: str, bad_path: str, checkpoint: str | None = None,
                  trigger: dict | None = None, fmt: str = "parquet", name: str | None = None):
    """T4: validate-and-split ingest. Each micro-batch is validated once
    (persisted), good rows go to ``good_path`` and bad rows to
    ``bad_path``, each under ``epoch=<id>`` written in overwrite mode, so a
    replayed epoch after a failure rewrites the same files (idempotent).
    The stream's checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``
    (a stable, shared location, so a restarted query resumes)."""
    if checkpoint is None:
        from jobledger.session import checkpoint_dir
        if not name:
            raise ValueError("give the stream a name or a checkpoint of its own")
        checkpoint = f"{checkpoint_dir(requests.sparkSession).rstrip('/')}/streams/{name}"
    def each(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            good, bad = split_requests(batch)
            good.write.mode("overwrite").format(fmt).save(f"{good_path}/epoch={epoch_id}")
            bad.write.mode("overwrite").format(fmt).save(f"{bad_path}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    w = requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
