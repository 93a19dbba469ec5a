"""S1/S2 files, U3 ids, L1 pages, J8 staleness."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from jobledger.operators import joins as J
from jobledger.operators import pages as L
from jobledger.operators import registry as U
from jobledger.sources import jobs as S
from jobledger.sources.events import encode_events, read_events


def test_jobs_written_and_read_back(spark):
    d = tempfile.mkdtemp(prefix="jl-jobs-", dir="/tmp")
    rows = [("j1", "email.send", "available", "default", 0, 0, 3, None, ["a"], '{"k":1}', None,
             dt.datetime(2024, 1, 1, 0, 0, 0, 123000), '[{"to":"x"}]'),
            ("j2", "report", "completed", "q", 2, 1, 3, 5000, [], None, '{"ok":true}',
             dt.datetime(2024, 1, 2), "[1,2]")]
    df = spark.createDataFrame(rows, "id string, type string, state string, queue string, priority int, attempt int, "
                                     "max_attempts int, timeout_ms bigint, tags array<string>, meta string, "
                                     "result string, created_at timestamp, args string")
    S.write_jobs(df, f"{d}/out")
    with open(f"{d}/bad.json", "w") as fh:
        fh.write("this is not a job\n")
    text = [r.value for r in spark.read.text(f"{d}/out").collect()]
    j1 = [t for t in text if '"j1"' in t][0]
    assert '"created_at":"2024-01-01T00:00:00.123Z"' in j1 and '"timeout_ms"' not in j1
    assert '"args":[{"to":"x"}]' in j1
    ok, bad = S.read_jobs(spark, [f"{d}/out", f"{d}/bad.json"])
    got = {r.id: r for r in ok.collect()}
    assert got["j2"].args_map is not None and got["j2"].timeout_ms == 5000
    assert got["j1"].tags == ["a"] and got["j2"].tags is None
    assert bad.count() == 1


def test_events_read_as_batch_and_stream(spark):
    d = tempfile.mkdtemp(prefix="jl-events-", dir="/tmp")
    ev = spark.createDataFrame([("job.completed", "w", "j1", dt.datetime(2024, 1, 1), '{"a":1}')],
                               "type string, source string, subject string, time timestamp, data string")
    encode_events(ev).write.text(f"{d}/ev")
    assert read_events(spark, f"{d}/ev").first().subject == "j1"
    assert read_events(spark, f"{d}/ev", streaming=True).isStreaming


def test_materialise_ids_are_sequential(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("request_id"), F.lit("t").alias("type"),
                                     F.when(F.col("id") % 3 == 0, "").otherwise("q").alias("queue"),
                                     F.timestamp_seconds(F.col("id") * 7 % 5000).alias("created_at"))
    out = U.materialise_jobs(df.repartition(7), prefix="fake-")
    rows = out.select("id", "request_id", "created_at", "queue").collect()
    ordered = sorted(rows, key=lambda r: (r.created_at, r.request_id))
    assert [r.id for r in ordered] == [f"fake-{i:06d}" for i in range(1, 5001)]
    assert {r.queue for r in rows} == {"default", "q"}


def test_pages(spark):
    df = spark.range(0, 95).withColumnRenamed("id", "job_id")
    page, meta = L.paginate(df, [F.col("job_id")], limit=10, offset=90)
    assert [r.job_id for r in page.collect()] == list(range(90, 95))
    m = meta.first()
    assert (m.total, m.limit, m.offset, m.has_more) == (95, 10, 90, False)
    _, meta2 = L.paginate(df, [F.col("job_id")], limit=10, offset=10)
    assert meta2.first().has_more is True


def test_page_after_walks_the_whole_table(spark):
    rows = [(i, [None, 1, 2, 3][i % 4]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, k int").repartition(4)
    keys = [("k", True), ("id", False)]
    seen, after = [], None
    while page := L.page_after(df, keys, 7, after).collect():
        seen += page
        after = page[-1].asDict()
    assert [(r.id, r.k) for r in seen] == sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))


def test_stale_jobs(spark):
    t = dt.datetime(2024, 1, 1, 12, 0)
    jobs = spark.createDataFrame([("a", "active", 60000), ("b", "active", 60000), ("c", "active", None),
                                  ("d", "completed", 1)], "job_id string, state string, visibility_timeout_ms long")
    hb = spark.createDataFrame([("w", t - dt.timedelta(seconds=30), ["a"]), ("w", t - dt.timedelta(seconds=90), ["b"]),
                                ("w", t + dt.timedelta(seconds=10), ["b"])],
                               "worker_id string, ts timestamp, active_job_ids array<string>")
    got = {r.job_id: r.reclaimable for r in J.stale_jobs(jobs, hb, t).collect()}
    assert got == {"a": False, "b": True, "c": True}


def test_pages_by_rank(spark, tmp_path):
    rows = [(i, (i * 7) % 10 if i % 11 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "job_id long, prio int")
    keys = [("prio", True), ("job_id", False)]
    pages = L.write_pages(df, keys, f"file:{tmp_path}/pages")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for offset, limit in [(0, 10), (95, 30), (180, 20), (195, 20), (200, 5), (0, 500), (10, 0)]:
        assert [tuple(r) for r in L.page_at(pages, keys, limit, offset).collect()] == want[offset:offset + limit], (offset, limit)
    empty = L.write_pages(df.limit(0), keys, f"file:{tmp_path}/empty")
    assert L.page_at(empty, keys, 10, 0).count() == 0 and empty.drop("_slice").columns == df.columns


def test_duration_quantiles_by_span(spark):
    import datetime as dt

    from jobledger.operators import aggregations as A
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "q", t + dt.timedelta(minutes=i % 600), float(i * 7919 % 20000)) for i in range(20000)] + [
        ("a", "q", t, None), ("a", "q", t, float("nan")), ("b", "q", None, 5.0)]
    sk = A.duration_sketches(spark.createDataFrame(rows, "type string, queue string, started_at timestamp_ntz, duration_ms double"))
    got = {(r.type, r.quantile): r for r in A.duration_quantiles(sk, [0.0, 0.25, 0.99, 1.0], "2024-01-01 02:00:00", "2024-01-01 05:00:00").collect()}
    exact = sorted(r[3] for r in rows[:20000] if 2 <= r[2].hour < 5)
    assert {k[0] for k in got} == {"a"} and got[("a", 0.25)].n == len(exact)
    for (_, q), r in got.items():
        at = sum(x <= r.duration_ms for x in exact) / len(exact)
        assert abs(at - q) <= 0.01, (q, at)
    every = A.duration_quantiles(sk, [0.5], by=()).collect()
    assert len(every) == 1 and every[0].n == 20001
