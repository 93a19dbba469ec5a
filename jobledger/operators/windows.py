"""Window functions and ordered folds.

Running folds per key go through ``plans.scan`` (sliced two-level scan) so
a hot worker or job is split across many tasks; top-n per group uses
``row_number() <= n`` which Spark plans with a partial WindowGroupLimit
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.functions.timecols import diff_ms, plus_ms, ts_lit
from jobledger.plans import scan


# --- W1 -----------------------------------------------------------------------

def _dispatch_order():
    return [F.col("_qord").asc_nulls_last(), F.col("priority").desc_nulls_last(),
            F.col("created_at").asc_nulls_last(), F.col("job_id")]


def dispatch(jobs: DataFrame, queues: DataFrame, n: int, per_queue: bool = False) -> DataFrame:
    """Next jobs to hand out: available jobs of queues that are not
    paused, in the worker's queue order, then priority (high first), then
    oldest, then id. ``per_queue`` gives the top ``n`` of each queue
    (``rank`` column), otherwise the top ``n`` overall."""
    q = queues.select("queue", F.col("ord").alias("_qord"), F.col("status").alias("_qstatus"))
    avail = jobs.filter(F.col("state") == "available")
    j = avail.join(q, "queue", "inner").filter(~F.col("_qstatus").eqNullSafe("paused"))
    if per_queue:
        w = Window.partitionBy("queue").orderBy(*_dispatch_order()[1:])
        return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("_qord", "_qstatus")
    return j.orderBy(*_dispatch_order()).limit(n).drop("_qord", "_qstatus")


# --- W2 -----------------------------------------------------------------------

def retry_delay_ms(n, initial_ms, coefficient, max_ms):
    """Delay after failed attempt ``n`` (1-based): min(max, initial * coef^(n-1))."""
    return F.least(F.lit(max_ms).cast("double"),
                   F.lit(initial_ms).cast("double") * F.pow(F.lit(coefficient), n - 1))


def retry_plan(attempts: DataFrame, policy: dict | None = None) -> DataFrame:
    """The retry decision for each job from its latest attempt.

    Policy fields default to max_attempts 3, initial 1 s, coefficient 2.0,
    max 5 min, jitter on. A failed attempt ``n`` is discarded when it is not
    retryable, its code starts with a listed non-retryable prefix, or
    ``n >= max_attempts``; otherwise it is retried after
    ``least(max, initial * coef^(n-1))`` (times ``0.5 + 0.5 * h`` with jitter,
    ``h`` in [0, 1) from the first 32 bits of the MD5 of ``<job id>:<n>``, so
    that a plan made twice, or by another engine, has the same times).
    """
    p = {"max_attempts": K.DEFAULT_MAX_ATTEMPTS, "initial_interval_ms": K.DEFAULT_INITIAL_INTERVAL_MS,
         "backoff_coefficient": K.DEFAULT_BACKOFF_COEFFICIENT, "max_interval_ms": K.DEFAULT_MAX_INTERVAL_MS,
         "jitter": K.DEFAULT_JITTER, "non_retryable_errors": []}
    p.update({k: v for k, v in (policy or {}).items() if v is not None})
    last = attempts.groupBy("job_id").agg(F.max_by(
        F.struct("attempt", "started_at", "duration_ms", "outcome", "error_code", "retryable"), "attempt").alias("l"))
    n = F.col("l.attempt")
    code = F.coalesce(F.col("l.error_code"), F.lit(""))
    prefixes = F.array(*[F.lit(x) for x in p["non_retryable_errors"]]) if p["non_retryable_errors"] \
        else F.array().cast("array<string>")
    listed = F.exists(prefixes, lambda x: code.startswith(x))
    failed = F.col("l.outcome") != "completed"
    discard = ~F.coalesce(F.col("l.retryable"), F.lit(False)) | listed | (n >= p["max_attempts"])
    decision = F.when(~failed, F.lit("none")).when(discard, F.lit("discard")).otherwise(F.lit("retry"))
    delay = retry_delay_ms(n, p["initial_interval_ms"], p["backoff_coefficient"], p["max_interval_ms"])
    if p["jitter"]:
        digest = F.md5(F.concat(F.col("job_id").cast("string"), F.lit(":"), n.cast("string")).cast("binary"))
        h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
        delay = delay * (F.lit(0.5) + F.lit(0.5) * h)
    delay_ms = F.floor(delay).cast("bigint")
    finished = plus_ms(F.col("l.started_at"), F.col("l.duration_ms"))
    return last.select(
        "job_id", n.alias("attempt"), decision.alias("decision"),
        F.when(decision == "retry", delay_ms).alias("delay_ms"),
        F.when(decision == "retry", plus_ms(finished, delay_ms)).alias("next_run_at"))


# --- W4 -----------------------------------------------------------------------

def fetch_backoff_ms(n, base_ms):
    """Wait after the n-th consecutive fetch error: n <= 1 -> base (not
    capped); else min(base * 2^min(n-1, 10), 30 s)."""
    shift = F.least(n - 1, F.lit(K.MAX_FETCH_SHIFT))
    grown = F.least(F.lit(base_ms).cast("bigint") * F.pow(F.lit(2), shift).cast("bigint"),
                    F.lit(K.MAX_FETCH_BACKOFF_MS).cast("bigint"))
    return F.when(n <= 1, F.lit(base_ms).cast("bigint")).otherwise(grown)


def fetch_backoff(polls: DataFrame, base_ms: int = 1000, key: str = "worker",
                  order: tuple[str, str] = ("ts", "event_id")) -> DataFrame:
    """For each failed poll, the length of the current error streak and
    the backoff the worker waits; successful polls reset the streak.

    Gaps and islands without a per-worker window: the running count of
    failures and, at each success, that count -- the streak is the
    difference (two running folds over the same slices, see ``plans.scan``).
    """
    order = list(order)
    failed_i = F.col("failed").cast("int")
    f = scan.running(scan.slices(polls, key, order), key, order, failed_i, "_fails")
    f = scan.running(f, key, order, F.when(~F.col("failed"), F.col("_fails")), "_at_success", "max")
    streak = F.col("_fails") - F.coalesce(F.col("_at_success"), F.lit(0))
    return f.select(*polls.columns,
                    F.when(F.col("failed"), streak).alias("streak"),
                    F.when(F.col("failed"), fetch_backoff_ms(streak, base_ms)).alias("backoff_ms"))


# --- W5 -----------------------------------------------------------------------

def worker_state(directives: DataFrame, key: str = "worker", order: tuple[str, str] = ("ts", "event_id")
                 ) -> DataFrame:
    """Worker state after each server directive.

    Start ``running``; ``terminate`` is absorbing; otherwise the state is the
    latest ``running`` / ``quiet`` directive (others ignored). Closed form of
    the transition table: a running "terminate seen" flag and the latest
    valid directive (running max of (ts, event_id, value)).
    """
    order = list(order)
    d = F.col("desired")
    b = scan.slices(directives, key, order)
    t = scan.running(b, key, order, (d == "terminate").cast("int"), "_term", "max")
    valid = F.when(d.isin("running", "quiet"), F.struct(*[F.col(c) for c in order], d.alias("v")))
    t = scan.running(t, key, order, valid, "_last", "max")
    state = (F.when(F.col("_term") == 1, F.lit("terminate"))
              .otherwise(F.coalesce(F.col("_last.v"), F.lit("running"))))
    return t.select(*directives.columns, state.alias("state"))


# --- W6 / W7 ------------------------------------------------------------------

def _event_state():
    e = F.col("type")
    expr = None
    for ev, st in K.EVENT_STATE.items():
        expr = F.when(e == ev, F.lit(st)) if expr is None else expr.when(e == ev, F.lit(st))
    return expr


def current_state(events: DataFrame, as_of=None) -> DataFrame:
    """Each job's state as of a time: the latest state-changing ``job.*``
    event at or before ``as_of`` (ties by event id); progress and non-job
    events do not change it. One partial aggregate per job."""
    e = events.withColumn("_state", _event_state()).filter(F.col("_state").isNotNull())
    if as_of is not None:
        e = e.filter(F.col("time") <= ts_lit(as_of))
    last = e.groupBy("subject").agg(F.max_by(F.struct("_state", "time", "event_id"),
                                             F.struct("time", "event_id")).alias("l"))
    return last.select("subject", F.col("l._state").alias("state"), F.col("l.time").alias("since"),
                       F.col("l.event_id").alias("event_id"))


def state_timeline(events: DataFrame) -> DataFrame:
    """One interval per state-changing event: its state, start, the start
    of the next state change of the same job (NULL while current) and the
    time spent in milliseconds."""
    e = events.withColumn("state", _event_state()).filter(F.col("state").isNotNull()).select(
        "subject", "event_id", "time", "state")
    n = scan.next_row(e, "subject", ["time", "event_id"], ["time"])
    return n.select("subject", "event_id", "state", F.col("time").alias("start"),
                    F.col("next_time").alias("end"),
                    diff_ms(F.col("next_time"), F.col("time")).alias("duration_ms"))


def time_in_state(timeline: DataFrame) -> DataFrame:
    """Total closed time per (job, state) from ``state_timeline``."""
    return timeline.groupBy("subject", "state").agg(F.sum("duration_ms").alias("total_ms"),
                                                    F.count(F.lit(1)).alias("intervals"))


# --- W8 -----------------------------------------------------------------------

def active_over_time(attempts: DataFrame, by: str | None = "worker_id") -> DataFrame:
    """Running count of active attempts at every start (+1) and end (-1),
    ends before starts at the same instant; per ``by`` group or global
    (``by=None``) -- both through the sliced scan, never one task."""
    keys = [by] if by else []
    change = lambda ts, delta: F.struct(ts.alias("ts"), F.lit(delta).alias("delta"))
    both = F.array(change(F.col("started_at"), 1), change(plus_ms("started_at", "duration_ms"), -1))
    ev = attempts.select(*keys, F.inline(both))
    return scan.running(ev, by, ["ts", "delta"], F.col("delta"), "active")


def peak_concurrency(timeline: DataFrame, by: str | None = "worker_id") -> DataFrame:
    """Peak of ``active_over_time`` per group and the first time it is reached."""
    keys = [by] if by else []
    return timeline.groupBy(*keys).agg(
        F.max("active").alias("peak_active"),
        F.min_by("ts", F.struct(-F.col("active"), F.col("ts"))).alias("peak_at"),
        F.count(F.lit(1)).alias("changes"))


def peak_active(attempts: DataFrame, by: str | None = "worker_id") -> DataFrame:
    """``peak_concurrency(active_over_time(...))`` without the timeline.

    Starts and ends are range-partitioned on (group, time) into slices; each
    (group, slice) gives its sum, its largest running sum and when that is
    first reached. These summaries combine associatively: a slice's peak is
    its largest running sum above the sum of the group's earlier slices. Only
    one row a (group, slice) is ordered at the end, and no row is joined back.
    Attempts without a start or duration count no change there.
    """
    keys = [by] if by else []
    change = lambda ts, delta: F.struct(ts.alias("ts"), F.lit(delta).alias("delta"))
    both = F.array(change(F.col("started_at"), 1), change(plus_ms("started_at", "duration_ms"), -1))
    ev = attempts.select(*keys, F.inline(both)).filter("ts IS NOT NULL")
    ev = ev.repartitionByRange(*keys, "ts", "delta").withColumn("_bk", F.spark_partition_id())
    within = Window.partitionBy(*keys, "_bk").orderBy("ts", "delta").rowsBetween(Window.unboundedPreceding, 0)
    part = ev.withColumn("_run", F.sum("delta").over(within)).groupBy(*keys, "_bk").agg(
        F.sum("delta").alias("_sum"), F.max("_run").alias("_top"), F.count(F.lit(1)).alias("_n"),
        F.min_by("ts", F.struct(-F.col("_run"), F.col("ts"))).alias("_at"))
    earlier = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    top = part.withColumn("_top", F.col("_top") + F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    return top.groupBy(*keys).agg(
        F.max("_top").alias("peak_active"), F.min_by("_at", F.struct(-F.col("_top"), F.col("_at"))).alias("peak_at"),
        F.sum("_n").alias("changes"))
