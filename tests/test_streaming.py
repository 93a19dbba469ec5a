"""Each streaming operator on a file stream equals its batch run."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from harness import SF_SMALL

from jobledger.sources import fixtures as fx
from jobledger.streaming import latest, replay
from jobledger.streaming import operators as T
from jobledger.streaming.subscribe import subscribe


@pytest.fixture(scope="module")
def event_dir(spark):
    """job events split into 4 parquet files; the second half of the events
    is written first, so files arrive out of event-time order."""
    d = tempfile.mkdtemp(prefix="jl-stream-", dir="/tmp")
    ev = fx.job_events(spark, SF_SMALL).withColumn("time", F.col("time").cast("timestamp"))
    ev = ev.withColumn("_part", F.pmod(F.col("event_id"), F.lit(4)))
    for p in [2, 3, 0, 1]:
        ev.filter(F.col("_part") == p).drop("_part").coalesce(1).write.mode("append").parquet(f"{d}/events")
    hb = fx.heartbeats(spark, SF_SMALL).withColumn("ts", F.col("ts").cast("timestamp")).drop("active_job_ids")
    hb.coalesce(2).write.parquet(f"{d}/heartbeats")
    return d


def run_stream(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    out = spark.sql(f"SELECT * FROM {name}")
    return out


def stream_of(spark, path, schema_df):
    return spark.readStream.schema(schema_df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_throughput_stream_equals_batch(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/events")
    batch = T.stream_throughput(static, "1 hour", watermark="1000 days")
    stream = T.stream_throughput(stream_of(spark, f"{event_dir}/events", static), "1 hour", watermark="1000 days")
    got = run_stream(spark, stream, "t1", "complete")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_throughput_sliding_windows(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/events")
    batch = T.stream_throughput(static, "2 hours", slide="1 hour", watermark="1000 days")
    stream = T.stream_throughput(stream_of(spark, f"{event_dir}/events", static), "2 hours", slide="1 hour",
                                 watermark="1000 days")
    got = run_stream(spark, stream, "t1s", "complete")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_late_events_are_dropped_after_watermark(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/events")
    stream = T.stream_throughput(stream_of(spark, f"{event_dir}/events", static), "1 hour", watermark="1 minute")
    got = run_stream(spark, stream, "t1late", "append")
    total = sum(r.completed + r.failed for r in got.collect())
    every = static.filter(F.col("type").isin("job.completed", "job.failed")).count()
    assert 0 < total < every  # files arrive out of order: late ones are dropped


def test_current_state_stream_equals_batch(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/events")
    batch = T.stream_current_state(static).withColumn("since", F.col("since").cast("timestamp_ntz"))
    changes = T.stream_current_state(stream_of(spark, f"{event_dir}/events", static), watermark="1000 days")
    got = latest.latest_of_changes(replay.run(changes, tempfile.mkdtemp(prefix="jl-t2-", dir="/tmp"), "update"))
    assert sorted(got.collect()) == sorted(batch.collect())


def _files(spark, batches, schema):
    d = tempfile.mkdtemp(prefix="jl-files-", dir="/tmp")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
    return d, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")


def test_current_state_leaves_the_store_after_the_horizon(spark):
    t0 = dt.datetime(2024, 1, 1)

    def ev(i, job, typ, hours):
        return (i, typ, job, t0 + dt.timedelta(hours=hours))

    batches = [
        [ev(i, f"j{i}", "job.completed" if i % 2 else "job.started", i % 5) for i in range(200)],
        [ev(300, "j1", "job.cancelled", 0), ev(301, "j2", "job.failed", 9), ev(302, "x", "job.started", 30)],  # an earlier end, late
        [ev(400, "j3", "job.started", 33), ev(401, "x", "job.started", 60)],  # after the end, within the horizon
        [ev(500, "x", "job.started", 300)],
        [ev(550, "x", "job.started", 310)],  # timers fire after a batch's rows
        [ev(600, "j5", "job.started", 312), ev(601, "x", "job.started", 320)],  # beyond the horizon: a new life
    ]
    d, stream = _files(spark, batches, "event_id long, type string, subject string, time timestamp")
    query = replay.start(T.stream_current_state(stream, "48 hours", "36 hours"), f"{d}/out", f"{d}/checkpoint", "update")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) > 200 and held[-1] < 20
    got = {r.subject: r for r in latest.latest_of_changes(spark.read.parquet(f"{d}/out")).collect()}
    assert len(got) == 201 and (got["j1"].state, got["j1"].event_id, got["j1"].final) == ("cancelled", 300, True)
    assert (got["j2"].state, got["j2"].final) == ("retryable", False) and got["j3"].event_id == 3 and got["j3"].final
    assert (got["j5"].event_id, got["j5"].final) == (600, False)


def test_current_state_changes_are_rows_of_changes_only(spark):
    t0 = dt.datetime(2024, 1, 1)
    batches = [[(1, "job.started", "a", t0)], [(2, "job.completed", "a", t0 + dt.timedelta(hours=2))],
               [(3, "job.started", "a", t0 + dt.timedelta(hours=1)), (4, "job.started", "b", t0 + dt.timedelta(hours=3))]]
    d, stream = _files(spark, batches, "event_id long, type string, subject string, time timestamp")
    out = replay.run(T.stream_current_state(stream), d, "update").orderBy("subject", "version").collect()
    assert [(r.subject, r.event_id, r.final, r.version) for r in out] == [("a", 1, False, 1), ("a", 2, True, 2), ("b", 4, False, 1)]


def test_a_replayed_epoch_writes_over_itself(spark, monkeypatch):
    """The first attempt at each epoch dies between the two sinks."""
    req = fx.requests(spark, SF_SMALL).select("request_id", "batch_id", "type", "queue")
    d = tempfile.mkdtemp(prefix="jl-again-", dir="/tmp")
    req.repartition(3).write.parquet(f"{d}/in")
    split, tried = T.split_requests, set()

    def dying(batch):
        good, bad = split(batch)
        key = batch.agg(F.min("request_id")).first()[0]
        if key not in tried:
            tried.add(key)
            good.write.mode("overwrite").parquet(f"{d}/good/epoch={len(tried) - 1}")
            raise RuntimeError("lost")
        return good, bad

    monkeypatch.setattr(T, "split_requests", dying)
    for _ in range(10):
        src = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
        query = T.stream_ingest(src, f"{d}/good", f"{d}/bad", f"{d}/checkpoint", {"availableNow": True})
        try:
            query.awaitTermination()
            break
        except Exception as e:  # noqa: BLE001 - the stream's own exception
            assert "lost" in str(e)
    assert len(tried) == 3
    good, bad = split(req)
    assert sorted(spark.read.parquet(f"{d}/good").drop("epoch").collect()) == sorted(good.collect())
    assert sorted(spark.read.parquet(f"{d}/bad").drop("epoch").collect()) == sorted(bad.collect())


def test_arrivals_are_all_rows_out_of_order_and_a_closing_one(spark):
    rows = spark.range(2000).select(F.col("id"), F.timestamp_seconds(F.col("id") * 600).alias("t"), F.lit("x").alias("k"))
    d = tempfile.mkdtemp(prefix="jl-arrive-", dir="/tmp")
    stream = replay.arrive(rows.unionByName(spark.sql("SELECT -1L id, CAST(NULL AS timestamp) t, 'x' k")), f"{d}/in", "t", last={"k": "end"})
    out = replay.run(stream, d)
    assert out.filter("k = 'x'").count() == 2001 and out.filter("k = 'end'").select(F.year("t")).first()[0] == 1980
    order = [r.e for r in out.filter("k = 'x'").groupBy("epoch").agg(F.max("id").alias("e"), F.min("id").alias("s")).orderBy("epoch").collect()]
    starts = [r.s for r in out.filter("k = 'x' AND id >= 0").groupBy("epoch").agg(F.min("id").alias("s")).orderBy("epoch").collect()]
    assert any(s < e for s, e in zip(starts[1:], order[:-1]))  # a file has rows older than the file before
    d = tempfile.mkdtemp(prefix="jl-arrive-", dir="/tmp")
    assert replay.run(replay.arrive(rows.limit(0), f"{d}/in", "t"), d).count() == 0


def test_sessions_stream_equals_batch(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/heartbeats")
    batch = T.stream_worker_sessions(static, "30 minutes")
    stream = T.stream_worker_sessions(stream_of(spark, f"{event_dir}/heartbeats", static), "30 minutes",
                                      watermark="1000 days")
    got = run_stream(spark, stream, "t3", "complete")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_ingest_splits_and_is_idempotent(spark):
    d = tempfile.mkdtemp(prefix="jl-ingest-", dir="/tmp")
    req = fx.requests(spark, SF_SMALL).select("request_id", "batch_id", "type", "queue")
    req.coalesce(3).write.parquet(f"{d}/in")
    src = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    q = T.stream_ingest(src, f"{d}/good", f"{d}/bad", f"{d}/ckpt", trigger={"availableNow": True})
    q.awaitTermination(120)
    good = spark.read.parquet(f"{d}/good")
    bad = spark.read.parquet(f"{d}/bad")
    g, b = T.split_requests(req)
    assert good.count() == g.count() and bad.count() == b.count()
    assert good.count() + bad.count() == req.count()


def test_subscribe_stream(spark, event_dir):
    static = spark.read.parquet(f"{event_dir}/events")
    seen = []

    def count(df, epoch):
        seen.append(df.count())

    q = subscribe(stream_of(spark, f"{event_dir}/events", static), {"job.completed": count},
                  checkpoint=tempfile.mkdtemp(prefix="jl-sub-", dir="/tmp"), trigger={"availableNow": True})
    q.awaitTermination(120)
    assert sum(seen) == static.filter(F.col("type") == "job.completed").count()


def test_batch_sessions_match_session_window(spark):
    import random

    rng = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot" if rng.random() < 0.7 else f"w{rng.randrange(3)}", t0 + dt.timedelta(minutes=rng.randrange(20000)))
            for _ in range(3000)]
    rows += rows[:50]  # duplicate heartbeats
    df = spark.createDataFrame(rows, "worker_id string, ts timestamp_ntz")
    got = T.stream_worker_sessions(df, "45 minutes")
    ref = T.sessions_by_window(df.withColumn("_t", F.col("ts").cast("timestamp")), "45 minutes", "_t")
    assert sorted(got.collect()) == sorted(ref.collect())
