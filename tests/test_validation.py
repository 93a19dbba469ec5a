"""P1 / P2 / P3 table-driven cases."""

import pytest
from pyspark.sql import functions as F

from jobledger.operators import projections as P


def reasons(spark, col, values, fn):
    df = spark.createDataFrame([(v,) for v in values], f"{col} string")
    return [r[0] for r in fn(df).select(f"{col}_reason").collect()]


@pytest.mark.parametrize("value,ok", [
    ("email.send", True), ("process", True), ("", False), ("EmailSend", False),
    ("a" * 256, False), ("a" * 255, True), ("a.b-c_d.e9", True), ("a..b", False), ("9a", False),
    ("email.send\n", False),
])
def test_type_validation(spark, value, ok):
    [r] = reasons(spark, "type", [value], P.validate_types)
    assert (r is None) == ok, r


def test_type_reason_texts(spark):
    got = reasons(spark, "type", ["", "a" * 256, "Bad type"], P.validate_types)
    assert got[0] == "job type is required"
    assert got[1] == "job type must not exceed 255 characters, got 256"
    assert got[2].startswith('invalid job type "Bad type": must match pattern ^[a-z]')


def test_type_length_counts_bytes(spark):
    # 128 two-byte characters = 256 bytes
    [r] = reasons(spark, "type", ["é" * 128], P.validate_types)
    assert r == "job type must not exceed 255 characters, got 256"


@pytest.mark.parametrize("value,ok", [
    ("default", True), ("", True), ("my-queue", True), ("queue.v2", True), ("a" * 128, True),
    ("MyQueue", False), ("a" * 129, False), ("default\n", False), (".q", False),
])
def test_queue_validation(spark, value, ok):
    [r] = reasons(spark, "queue", [value], P.validate_queues)
    assert (r is None) == ok, r


def test_split_terminal(spark):
    states = ["pending", "scheduled", "available", "active", "retryable", "completed", "cancelled", "discarded"]
    df = spark.createDataFrame([(s,) for s in states], "state string")
    open_, done = P.split_terminal(df)
    assert sorted(r.state for r in open_.collect()) == sorted(states[:5])
    assert sorted(r.state for r in done.collect()) == sorted(states[5:])


def test_merge_meta_later_wins(spark):
    df = spark.createDataFrame([(1, 1, "source", "api"), (1, 2, "version", "2"), (1, 2, "source", "override")],
                               "job_id int, seq int, meta_key string, meta_value string")
    got = {r.meta_key: r.meta_value for r in P.merge_meta(df).collect()}
    assert got == {"source": "override", "version": "2"}


def test_merge_meta_row_form(spark):
    df = spark.sql("SELECT map('source','api') AS a, map('version','2','source','override') AS b")
    [r] = df.select(P.merge_meta_row(F.col("a"), F.col("b")).alias("m")).collect()
    assert r.m == {"source": "override", "version": "2"}


def test_append_tags_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1, ["onboarding", "email"]), (1, 2, ["priority"]), (1, 3, ["email"])],
                               "job_id int, seq int, tags array<string>")
    got = [r.tag for r in P.append_tags(df).orderBy("pos").collect()]
    assert got == ["onboarding", "email", "priority", "email"]


def test_append_tags_hot_job_in_slices(spark):
    rows = [(1 if i % 3 else 2, i, [f"t{i}"] * (i % 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "job_id int, seq int, tags array<string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep all slices
    try:
        got = P.append_tags(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for job in (1, 2):
        want = [t for j, _, ts in sorted(rows, key=lambda r: r[1]) if j == job for t in ts]
        have = [r.tag for r in sorted((r for r in got if r.job_id == job), key=lambda r: r.pos)]
        assert have == want
        assert sorted(r.pos for r in got if r.job_id == job) == list(range(len(want)))


def test_resolve_options_wire_omissions(spark):
    df = spark.createDataFrame([(None, None, None, None), ("", 0, 1500, None), ("fast", 3, -1999, 2500)],
                               "queue string, priority int, timeout_us long, visibility_timeout_us long")
    got = [(r.queue, r.priority, r.timeout_ms, r.wire_options) for r in P.resolve_options(df).collect()]
    assert got == [("default", 0, 0, '{"queue":"default"}'),
                   ("default", 0, 1, '{"timeout_ms":1}'),
                   ("fast", 3, -1, '{"queue":"fast","priority":3,"timeout_ms":-1,"visibility_timeout_ms":2}')]


def test_resolve_run_at_last_option_wins(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    at = dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([(t, 60000, at, 1, 2), (t, 60000, at, 2, 1), (t, None, at, None, 1), (t, 5, None, 1, None)],
                               "created_at timestamp, delay_ms long, scheduled_at timestamp, delay_pos int, scheduled_pos int")
    got = [r.run_at for r in P.resolve_run_at(df).collect()]
    assert got == [at, t + dt.timedelta(minutes=1), at, t + dt.timedelta(milliseconds=5)]


def test_expire_jobs_skips_terminal(spark):
    import datetime as dt
    past, future = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([("a", "available", past), ("b", "completed", past), ("c", "active", future),
                                ("d", "scheduled", None)], "id string, state string, expires_at timestamp")
    got = {r.id: (r.state, r.expired) for r in P.expire_jobs(df, "2024-06-01 00:00:00").collect()}
    assert got == {"a": ("discarded", True), "b": ("completed", False), "c": ("active", False),
                   "d": ("scheduled", False)}


def test_trace_id_kept_or_derived(spark):
    df = spark.sql("SELECT 'j1' AS job_id, map('trace_id', 'abc') AS meta UNION ALL "
                   "SELECT 'j2', map('source', 'api') UNION ALL SELECT 'j3', CAST(NULL AS map<string,string>)")
    got = {r.job_id: r.meta for r in P.ensure_trace_id(df).collect()}
    import hashlib
    assert got["j1"] == {"trace_id": "abc"}
    assert got["j2"] == {"source": "api", "trace_id": hashlib.md5(b"j2").hexdigest()}
    assert got["j3"] == {"trace_id": hashlib.md5(b"j3").hexdigest()}
