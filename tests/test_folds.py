"""Ordered folds against plain-Python folds: W4, W5, W3, the sliced scan."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from jobledger.operators import unique as UQ
from jobledger.operators import windows as W
from jobledger.plans import scan

T0 = dt.datetime(2024, 1, 1)


def backoff_py(n, base):
    if n <= 1:
        return base
    return min(base * (1 << min(n - 1, 10)), 30_000)


@pytest.mark.parametrize("n,base,want", [(1, 1000, 1000), (2, 1000, 2000), (3, 1000, 4000), (100, 1000, 30000),
                                         (1, 60000, 60000), (2, 60000, 30000)])
def test_fetch_backoff_values(spark, n, base, want):
    rows = [("w", i, T0 + dt.timedelta(seconds=i), True) for i in range(n)]
    df = spark.createDataFrame(rows, "worker string, event_id long, ts timestamp, failed boolean")
    last = W.fetch_backoff(df, base_ms=base).orderBy("event_id").collect()[-1]
    assert (last.streak, last.backoff_ms) == (n, want)


def _polls(rng, n_workers=3, n=300):
    rows = []
    for i in range(n):
        w = f"w{rng.randrange(n_workers)}"
        rows.append((w, i, T0 + dt.timedelta(minutes=rng.randrange(0, 5000)), rng.random() < 0.6))
    return rows


def test_fetch_backoff_matches_fold(spark):
    rng = random.Random(7)
    rows = _polls(rng)
    df = spark.createDataFrame(rows, "worker string, event_id long, ts timestamp, failed boolean")
    got = {r.event_id: (r.streak, r.backoff_ms) for r in W.fetch_backoff(df, 1000).collect()}
    streak = {}
    for w, eid, ts, failed in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        streak[w] = streak.get(w, 0) + 1 if failed else 0
        want = (streak[w], backoff_py(streak[w], 1000)) if failed else (None, None)
        assert got[eid] == want


def test_worker_state_matches_fold(spark):
    rng = random.Random(3)
    rows = [(f"w{rng.randrange(3)}", i, T0 + dt.timedelta(minutes=rng.randrange(3000)),
             rng.choice(["running", "quiet", "terminate", "noop", "bogus", "quiet", "running"])) for i in range(400)]
    df = spark.createDataFrame(rows, "worker string, event_id long, ts timestamp, desired string")
    got = {r.event_id: r.state for r in W.worker_state(df).collect()}
    state = {}
    allowed = {("running", "quiet"), ("running", "terminate"), ("quiet", "terminate"), ("quiet", "running")}
    for w, eid, ts, d in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        cur = state.get(w, "running")
        if (cur, d) in allowed:
            cur = d
        state[w] = cur
        assert got[eid] == cur, (w, eid)


def unique_py(rows, period_us):
    """Greedy slots per key, the plain way."""
    out, anchors = {}, {}
    for key, ts, rid in sorted(rows):
        a = anchors.get(key)
        if a is None or (period_us > 0 and ts >= a[0] + period_us):
            anchors[key] = (ts, rid)
            out[rid] = ("accepted", rid)
        else:
            out[rid] = ("duplicate", a[1])
    return out


@pytest.mark.parametrize("period_ms", [0, 3_600_000, 86_400_000])
def test_unique_matches_fold_across_batches(spark, period_ms):
    rng = random.Random(period_ms)
    rows = [(f"k{rng.randrange(5)}", rng.randrange(0, 5 * 86_400_000_000), i) for i in range(600)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(microseconds=t), i) for k, t, i in rows],
                               "ukey string, created_at timestamp, request_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # keys cross batch borders
    try:
        got = {r.request_id: (r.status, r.slot_id) for r in
               UQ.apply_unique(df, period_ms, key_col="ukey").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    # the fold orders by the timestamp truncated to microseconds, as Spark stores it
    assert got == unique_py(rows, period_ms * 1000)


def _when(rng, bursty):
    if not bursty:
        return rng.randrange(0, 8 * 86_400_000_000)
    centre = rng.choice([0, 2, 5]) * 86_400_000_000
    return centre + rng.randrange(0, 2 * 3_600_000_000)


@pytest.mark.parametrize("period_ms,bursty", [(0, False), (3_600_000, False), (86_400_000, False),
                                              (600_000, True), (3_600_000, True)])
def test_unique_hot_keys_in_slices_match_fold(spark, many_slices, period_ms, bursty):
    rng = random.Random(100 + period_ms + bursty)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", _when(rng, bursty), i)
            for i in range(1500)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(microseconds=t), i) for k, t, i in rows],
                               "ukey string, created_at timestamp, request_id long")
    got = {r.request_id: (r.status, r.slot_id) for r in
           UQ.apply_unique(df, period_ms, key_col="ukey").collect()}
    assert got == unique_py(rows, period_ms * 1000)


@pytest.fixture
def rounds(monkeypatch):
    """Rows of each round's answers, by slice, with few allowed."""
    monkeypatch.setattr(UQ, "LIMIT", 8)
    seen, exits = [], UQ._exits

    def watched(period_us, asked, limit):
        seen.append(dict(asked))
        run = exits(period_us, asked, limit)

        def each(batches):
            for out in run(batches):
                assert len(out) <= limit + 4
                yield out
        return each

    monkeypatch.setattr(UQ, "_exits", watched)
    return seen


@pytest.mark.parametrize("period_ms", [0, 1, 1_000, 90_000, 1_100_000, 7_000_000, 90_000_000])
@pytest.mark.parametrize("shape", ["even", "burst", "dense"])
def test_unique_one_key_through_twenty_slices(spark, many_slices, rounds, period_ms, shape):
    """Periods from never and one tick to many slices long."""
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    rng = random.Random(f"{period_ms}{shape}")
    draw = {"even": lambda: rng.randrange(20_000_000), "burst": lambda: rng.choice([3_000_000, 9_000_000, 9_000_001]) + rng.randrange(2_000),
            "dense": lambda: rng.randrange(3_000)}[shape]
    rows = [("hot", draw(), i) for i in range(4000)] + [("a", 5, 9001), ("z", 5, 9002)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(milliseconds=t), i) for k, t, i in rows], "ukey string, created_at timestamp, request_id long")
    got = {r.request_id: (r.status, r.slot_id) for r in UQ.apply_unique(df, period_ms, key_col="ukey").collect()}
    assert got == unique_py(rows, period_ms)
    assert len(rounds) <= 8


@pytest.mark.parametrize("strategy", ["reject", "ignore", "replace", "replace_except_schedule"])
def test_unique_hot_key_strategies_in_rounds(spark, many_slices, rounds, strategy):
    rows = [("hot", i * 37 % 50_000, i) for i in range(3000)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(milliseconds=t), i) for k, t, i in rows], "ukey string, created_at timestamp, request_id long")
    folded = UQ.apply_unique(df, 9_000, strategy, key_col="ukey")
    want = unique_py([(k, t, i) for k, t, i in rows], 9_000)
    label = {"accepted": "accepted", "duplicate": UQ.STATUS[strategy]}
    assert {r.request_id: (r.status, r.slot_id) for r in folded.collect()} == {i: (label[s], slot) for i, (s, slot) in want.items()}
    assert UQ.unique_survivors(folded, strategy).count() == len({slot for _, slot in want.values()})


def test_requests_without_a_time_have_a_table_of_their_own(spark):
    rows = [("k", T0, 1, "x"), ("k", None, 2, "y"), ("j", None, 3, "z"), (None, None, 4, None)]
    folded = UQ.apply_unique(spark.createDataFrame(rows, "ukey string, created_at timestamp, request_id long, body string"), 1000, key_col="ukey")
    for strategy in UQ.STATUS:
        assert [(r.slot_id, r.payload_id, r.conflicts) for r in UQ.unique_survivors(folded, strategy).collect()] == [(1, 1, 0)]
    assert sorted((r.request_id, r.body) for r in UQ.unique_untimed(folded).collect()) == [(2, "y"), (3, "z"), (4, None)]


def test_running_sum_splits_hot_key(spark, many_slices):
    rng = random.Random(11)
    rows = [(rng.choice(["hot"] * 7 + ["a", "b", None]), i, T0 + dt.timedelta(seconds=rng.randrange(10**6)),
             rng.randrange(-3, 5)) for i in range(2000)]
    rows[0] = ("hot", 0, dt.datetime(1970, 1, 1), 1)  # an outlier clock
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp, v int")
    split = scan.running(df, "k", ["ts", "id"], F.col("v"), "s")
    plain = df.withColumn("s", F.sum("v").over(
        Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(split.select("id", "s").collect()) == sorted(plain.select("id", "s").collect())


def _slice_sizes(df, key, order):
    return sorted(r["count"] for r in scan.slices(df, key, order).groupBy("_bk").count().collect())


def test_slices_are_even_for_outliers_bursts_and_null_keys(spark, many_slices):
    base = spark.range(16_000).withColumn("ts", F.timestamp_seconds(F.when(F.col("id") == 0, 0).otherwise(1_700_000_000 + F.col("id"))))
    for df in (base.withColumn("k", F.lit("one")), base.withColumn("k", F.lit(None).cast("string")),
               base.withColumn("k", F.lit("one")).withColumn("ts", F.timestamp_seconds(F.lit(7)))):
        sizes = _slice_sizes(df, "k", ["ts", "id"])
        assert sum(sizes) == 16_000 and len(sizes) > 10 and sizes[-1] <= 2 * 16_000 / len(sizes)
        assert scan.next_row(df, "k", ["ts", "id"], ["id"]).filter("next_id = id + 1").count() == 15_999


def test_next_row_matches_lead(spark, many_slices):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, T0 + dt.timedelta(seconds=rng.randrange(10**5))])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp")
    got = scan.next_row(df, "k", ["ts", "id"], ["ts"])
    want = df.withColumn("next_ts", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    key = lambda r: r.id
    assert sorted(got.select("id", "next_ts").collect(), key=key) == sorted(want.select("id", "next_ts").collect(), key=key)


def test_global_running_sum(spark, many_slices):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7 - 3).alias("v"),
                                     F.timestamp_seconds(F.col("id") * 17).alias("ts"))
    total = 0
    for r in sorted(scan.running(df, None, ["ts", "id"], F.col("v"), "s").select("id", "v", "s").collect()):
        total += r.v
        assert r.s == total


def test_unique_without_a_time_or_key(spark):
    rows = [("k", T0, 1), ("k", None, 2), (None, T0, 3), (None, T0, 4), ("k", T0, 1)]
    df = spark.createDataFrame(rows, "ukey string, created_at timestamp, request_id long")
    got = sorted((r.request_id, r.status, r.slot_id) for r in UQ.apply_unique(df, 1000, key_col="ukey").collect())
    assert got == [(1, "accepted", 1), (1, "accepted", 1), (2, "no_time", None), (3, "accepted", 3), (4, "duplicate", 3)]


@pytest.mark.parametrize("period_ms", [0, 1000])
def test_unique_one_burst_within_a_period(spark, many_slices, period_ms):
    df = spark.range(2000).select(F.lit("k").alias("ukey"), F.timestamp_millis(F.col("id") % 10).alias("created_at"), F.col("id").alias("request_id"))
    got = UQ.apply_unique(df, period_ms, "ignore", key_col="ukey").groupBy("status", "slot_id").count().collect()
    assert {(r.status, r.slot_id): r["count"] for r in got} == {("accepted", 0): 1, ("ignored", 0): 1999}


@pytest.fixture
def many_slices(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_fetch_backoff_matches_fold_in_slices(spark, many_slices):
    test_fetch_backoff_matches_fold(spark)


def test_worker_state_matches_fold_in_slices(spark, many_slices):
    test_worker_state_matches_fold(spark)


def test_state_timeline_in_slices(spark, many_slices):
    rng = random.Random(21)
    types = ["job.enqueued", "job.started", "job.completed", "job.failed", "job.progress"]
    rows = [(i, rng.choice(types), f"j{rng.randrange(3)}", T0 + dt.timedelta(seconds=rng.randrange(10**5)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, type string, subject string, time timestamp")
    got = {r.event_id: r.end for r in W.state_timeline(df).collect()}
    seq = {}
    for eid, typ, subj, t in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if typ != "job.progress":
            seq.setdefault(subj, []).append((eid, t))
    want = {}
    for subj, evs in seq.items():
        for (eid, _), nxt in zip(evs, evs[1:] + [(None, None)]):
            want[eid] = nxt[1]
    assert got == want


@pytest.mark.parametrize("by", ["worker_id", None])
def test_peak_without_timeline_equals_the_timelines(spark, by):
    rnd = random.Random(5)
    t = dt.datetime(2024, 1, 1)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["w1", "w2", None]), t + dt.timedelta(seconds=rnd.randrange(300)), rnd.choice([0, 1000, 5000, 60000]))
            for _ in range(1500)] + [("late", t + dt.timedelta(days=9000), 1), ("none", None, 5)]
    a = spark.createDataFrame(rows, "worker_id string, started_at timestamp_ntz, duration_ms long")
    timed = a.filter("started_at IS NOT NULL")
    want = W.peak_concurrency(W.active_over_time(timed, by=by), by=by).collect()
    got = W.peak_active(a, by=by).collect()
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(want)
