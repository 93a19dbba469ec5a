"""Aggregations over the job ledger.

Every aggregate is one ``groupBy().agg()`` pass: Spark plans a partial
(map-side) aggregate before the shuffle, so a hot queue or type collapses to
one row per task before it moves. Conditional counts use ``count_if`` instead
of separate filtered scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.functions.timecols import diff_ms, plus_ms, ts_lit

STAT_STATES = ["available", "active", "scheduled", "retryable", "discarded"]


def queue_stats(jobs: DataFrame, attempts: DataFrame, as_of, window_seconds: int = 3600, queues: DataFrame | None = None) -> DataFrame:
    """A1: per-queue statistics (ours, the protocol only names the fields).

    * counts of jobs by current state (``jobs.state``);
    * completed / failed attempts finishing in ``(as_of - window, as_of]``,
      finish = ``started_at + duration_ms``;
    * average duration of completed attempts and average wait
      ``started_at - coalesce(enqueued_at, created_at)`` (negative waits
      excluded), in ms;
    * throughput = completed in the window / window seconds;
    * the queue's status (``active`` unless ``queues`` says otherwise) and the
      time of the statistics. Registered queues without jobs have zero counts.
    """
    hi = ts_lit(as_of)
    lo = hi - F.make_dt_interval(secs=F.lit(window_seconds))
    by_state = jobs.groupBy("queue").agg(
        *[F.count_if(F.col("state") == s).alias(s) for s in STAT_STATES])

    ready = F.coalesce(F.col("enqueued_at"), F.col("created_at")) if "enqueued_at" in jobs.columns \
        else F.col("created_at")
    att = attempts.select("job_id", "started_at", "duration_ms", "outcome").join(
        jobs.select("job_id", "queue", ready.alias("_ready_at")), "job_id")
    finished = plus_ms("started_at", "duration_ms")
    in_window = (finished > lo) & (finished <= hi)
    wait = diff_ms("started_at", "_ready_at")
    by_attempt = att.groupBy("queue").agg(
        F.count_if((F.col("outcome") == "completed") & in_window).alias("completed_last_hour"),
        F.count_if((F.col("outcome") == "failed") & in_window).alias("failed_last_hour"),
        F.avg(F.when(F.col("outcome") == "completed", F.col("duration_ms"))).alias("avg_duration_ms"),
        F.avg(F.when(wait >= 0, wait)).alias("avg_wait_ms"),
    )
    out = by_state.join(by_attempt, "queue", "left")
    if queues is not None:
        known = queues.groupBy(F.col("queue").alias("_q")).agg(F.max("status").alias("status"))
        out = out.join(known, F.col("queue").eqNullSafe(F.col("_q")), "full").withColumn("queue", F.coalesce("queue", "_q"))
    else:
        out = out.withColumn("status", F.lit(None).cast("string"))
    return out.select(
        "queue", F.coalesce("status", F.lit("active")).alias("status"), hi.alias("computed_at"),
        *[F.coalesce(s, F.lit(0)).cast("bigint").alias(s) for s in STAT_STATES],
        F.coalesce("completed_last_hour", F.lit(0)).cast("bigint").alias("completed_last_hour"),
        F.coalesce("failed_last_hour", F.lit(0)).cast("bigint").alias("failed_last_hour"),
        F.round("avg_duration_ms", 6).alias("avg_duration_ms"),
        F.round("avg_wait_ms", 6).alias("avg_wait_ms"),
        F.round(F.coalesce("completed_last_hour", F.lit(0)) / F.lit(float(window_seconds)), 6)
         .alias("throughput_per_second"),
    )


def list_queues(jobs: DataFrame, queues: DataFrame | None = None) -> DataFrame:
    """A2: every queue seen in the ledger or registered in the queue table, with
    its status (``active`` unless the table says otherwise), the time its first
    job was created and its number of jobs (0 for an idle queue)."""
    seen = jobs.groupBy("queue").agg(F.min("created_at").alias("created_at"),
                                     F.count(F.lit(1)).alias("jobs"))
    if queues is None:
        return seen.select(F.col("queue").alias("name"), F.lit("active").alias("status"), "created_at", "jobs")
    q = queues.select("queue", "status")
    return seen.join(q.select(F.col("queue").alias("_q"), "status"), F.col("queue").eqNullSafe(F.col("_q")), "full").select(
        F.coalesce("queue", "_q").alias("name"), F.coalesce("status", F.lit("active")).alias("status"), "created_at",
        F.coalesce("jobs", F.lit(0)).cast("bigint").alias("jobs"))


def job_metrics(attempts: DataFrame, buckets: list[float] | None = None,
                quantiles: list[float] | None = None) -> DataFrame:
    """A3: execution metrics per (type, queue): started / completed / failed
    counters, duration sum, count, min and max (ms as whole microseconds /
    1000) and a histogram with one count per bucket ``(edge[i-1], edge[i]]``
    plus an overflow bucket. ``quantiles`` adds ``percentile_approx`` columns.
    """
    from jobledger import constants as K

    edges = buckets or K.DURATION_BUCKETS_MS
    d = F.floor(F.col("duration_ms") * 1000) / F.lit(1000.0)
    aggs = [
        F.count(F.lit(1)).alias("started"),
        F.count_if(F.col("outcome") == "completed").alias("completed"),
        F.count_if(F.col("outcome") != "completed").alias("failed"),
        F.round(F.sum(d), 6).alias("duration_sum_ms"),
        F.count(d).alias("duration_count"),
        F.min(d).alias("duration_min_ms"),
        F.max(d).alias("duration_max_ms"),
    ]
    prev = None
    for e in edges:
        cond = d <= e if prev is None else (d > prev) & (d <= e)
        aggs.append(F.count_if(cond).alias(f"bucket_le_{_edge_name(e)}"))
        prev = e
    aggs.append(F.count_if(d > prev).alias("bucket_inf"))
    for q in quantiles or []:
        aggs.append(F.percentile_approx(d, q, 10000).alias(f"p{int(q * 100)}_ms"))
    return attempts.groupBy("type", "queue").agg(*aggs)


# rank error of a duration sketch: under 1 % (a sketch of some 10 KB at most)
SKETCH_K = 400


def duration_sketches(attempts: DataFrame, width: str = "hour") -> DataFrame:
    """A3, distributions that can be read over any window later: one quantile
    sketch (KLL) of the attempts' durations per (type, queue, ``width`` of the
    start). Sketches merge without loss of their bound, in tasks before the
    shuffle as well. Attempts without a duration are not counted; those without
    a start have a NULL ``period`` of their own."""
    d = F.col("duration_ms").cast("double")
    return attempts.filter(d.isNotNull() & ~F.isnan(d)).groupBy(
        "type", "queue", F.date_trunc(width, "started_at").cast("timestamp_ntz").alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(d, SKETCH_K).alias("sketch"))


def duration_quantiles(sketches: DataFrame, quantiles: list[float], start=None, end=None, by: tuple[str, ...] = ("type", "queue")) -> DataFrame:
    """Quantiles per ``by`` (none: of all) from the sketches whose period lies
    in ``[start, end)``: ``(by..., n, quantile, duration_ms)``. Their rank is
    within 1 % of the exact one. No sketch in the span gives no row."""
    s = sketches
    if start is not None:
        s = s.filter(F.col("period") >= ts_lit(start))
    if end is not None:
        s = s.filter(F.col("period") < ts_lit(end))
    m = s.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("_s")).filter("n > 0")
    q = F.array(*[F.lit(float(x)) for x in quantiles])
    return m.select(*by, "n", F.explode(F.arrays_zip(q.alias("quantile"), F.kll_sketch_get_quantile_double("_s", q).alias("duration_ms"))).alias("r")).select(
        *by, "n", "r.quantile", "r.duration_ms")


def _edge_name(e: float) -> str:
    return str(int(e)) if float(e).is_integer() else str(e).replace(".", "_")


def describe_jobs(jobs: DataFrame) -> DataFrame:
    """A4: job count per type."""
    return jobs.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def expect_jobs(jobs: DataFrame, specs: list[dict]) -> DataFrame:
    """A5: table expectations evaluated in ONE pass over ``jobs``.

    Each spec: ``name``, ``kind`` (``enqueued`` / ``refute`` / ``performed``),
    ``type``, optional ``queue``, ``count``, ``args``, ``meta`` (the P12
    matcher). ``enqueued`` with count 0 means at least one; ``performed``
    counts jobs that ran (attempt > 0) and ignores ``count``.
    """
    from jobledger.operators.projections import _canon_literal  # shared matcher pieces
    from jobledger.functions import args as A

    conds = []
    for s in specs:
        c = F.col("type") == F.lit(s["type"])
        if s.get("queue"):
            c = c & (F.col("queue") == F.lit(s["queue"]))
        if s.get("args") is not None:
            actual = F.to_json(A.sorted_map(F.coalesce(F.col("args_map"), F.create_map().cast(A.ARGS_MAP))))
            c = c & (A.canonical_json(actual) == _canon_literal(s["args"]))
        if s.get("meta") is not None:
            m = A.parse("meta")
            for k, v in s["meta"].items():
                got = F.coalesce(F.to_json(F.try_variant_get(m, f"$['{k}']", "variant")), F.lit("null"))
                c = c & (got == _canon_literal(v))
        if s.get("kind") == "performed":
            c = c & (F.col("attempt") > 0)
        conds.append(F.count_if(c).alias(f"_s{len(conds)}"))
    counts = jobs.agg(*conds)
    rows = []
    for i, s in enumerate(specs):
        found = F.col(f"_s{i}")
        kind = s.get("kind", "enqueued")
        want = int(s.get("count", 0) or 0)
        if kind == "refute":
            passed = found == 0
        elif kind == "performed" or want == 0:
            passed = found >= 1
        else:
            passed = found == want
        rows.append(F.struct(F.lit(s["name"]).alias("spec"), F.lit(kind).alias("kind"),
                             F.lit(want).cast("bigint").alias("expected"), found.cast("bigint").alias("found"),
                             passed.alias("passed")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enqueue_batch(requests: DataFrame, batch: str = "batch_id", seq: str = "seq"):
    """Atomic batch validation.

    A batch fails as a whole at its first invalid request (lowest ``seq``,
    the 0-based position in the batch) with ``job[<seq>]: <reason>``.
    Returns ``(batches, accepted)``: one row per batch, and the requests of
    the batches that passed (a left-semi join on the batch key).
    """
    from jobledger.functions.validation import request_reason

    checked = requests.withColumn("_reason", request_reason("type", "queue"))
    first_bad = F.min_by(F.struct(F.col(seq), F.col("_reason")),
                         F.when(F.col("_reason").isNotNull(), F.col(seq)))
    batches = checked.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_jobs"),
        F.count_if(F.col("_reason").isNotNull()).alias("n_invalid"),
        first_bad.alias("_first"))
    batches = batches.select(
        batch, "n_jobs", (F.col("n_invalid") == 0).alias("accepted"),
        F.when(F.col("n_invalid") > 0, F.format_string("job[%d]: %s", F.col("_first")[seq], F.col("_first._reason")))
         .alias("error"))
    accepted = requests.join(batches.filter("accepted").select(batch), batch, "left_semi")
    return batches, accepted


def error_rollup(errors: DataFrame, order: str = "event_id") -> DataFrame:
    """A10: errors grouped by code, sentinel class and retryability, with a
    count and the formatted text of the earliest error as a sample."""
    from jobledger.functions.errors import error_class, error_text

    e = errors.withColumn("error_class", error_class("code", "status")).withColumn(
        "_text", error_text("code", "message", "request_id"))
    return e.groupBy("code", "error_class", "retryable").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("_text", order).alias("sample"))


def batch_failures(items: DataFrame) -> DataFrame:
    """Failed message ids per batch (sorted), for partial batch responses.

    A message batch is bounded by the queue protocol (a handful of records),
    so gathering one batch's failed ids is bounded.
    """
    failed = items.filter(F.col("failed"))
    return failed.groupBy("batch_id").agg(
        F.sort_array(F.collect_list("message_id")).alias("failed_ids"),
        F.count(F.lit(1)).alias("n_failed"))


WORKER_ID_PATTERN = r"^worker_(.*)_(\d+)_(\d+)\z"


def worker_load(heartbeats: DataFrame, concurrency: int = 10) -> DataFrame:
    """Per worker the latest heartbeat (of equal times the largest
    ``event_id``, or the longest list where there is none), its active job count, free
    capacity and fetch size, and host / pid / start parsed from the id
    ``worker_<host>_<pid>_<nanos>`` (the host may itself contain ``_``)."""
    order = F.struct(F.col("ts"), F.col("event_id")) if "event_id" in heartbeats.columns else \
        F.struct(F.col("ts"), F.coalesce(F.size("active_job_ids"), F.lit(0)))
    latest = F.max_by(F.size("active_job_ids"), order)
    w = heartbeats.groupBy("worker_id").agg(
        F.max("ts").alias("last_seen"), latest.alias("active"), F.count(F.lit(1)).alias("heartbeats"))
    active = F.coalesce(F.col("active"), F.lit(0))
    return w.select(
        "worker_id", "last_seen", "heartbeats", active.alias("active"),
        F.greatest(F.lit(concurrency) - active, F.lit(0)).alias("free_capacity"),
        F.when(active >= concurrency, F.lit(0)).otherwise(F.greatest(F.lit(concurrency) - active, F.lit(1)))
         .alias("fetch_count"),
        F.nullif(F.regexp_extract("worker_id", WORKER_ID_PATTERN, 1), F.lit("")).alias("host"),
        F.nullif(F.regexp_extract("worker_id", WORKER_ID_PATTERN, 2), F.lit("")).cast("bigint").alias("pid"),
        F.nullif(F.regexp_extract("worker_id", WORKER_ID_PATTERN, 3), F.lit("")).cast("bigint").alias("started_ns"),
    )


RATE_LIMIT_HEADERS = ["Retry-After", "X-RateLimit-Limit", "X-RateLimit-Remaining", "X-RateLimit-Reset"]


def headers_lookup(headers: str, names: list[str]) -> "F.Column":
    """First value of each header, names matched case-insensitively, '' when
    absent -- one pass over the header entries for all names."""
    low = [n.lower() for n in names]
    init = F.struct(*[F.lit(None).cast("string").alias(f"h{i}") for i in range(len(names))])

    def step(acc, e):
        k = F.lower(e["key"])
        return F.struct(*[F.when(acc[f"h{i}"].isNull() & (k == n), e["value"]).otherwise(acc[f"h{i}"]).alias(f"h{i}")
                          for i, n in enumerate(low)])

    found = F.aggregate(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
                        init, step)
    return F.struct(*[F.coalesce(found[f"h{i}"], F.lit("")).alias(f"h{i}") for i in range(len(names))])


def _whole(c) -> "F.Column":
    """A signed whole number, nothing around it; any other text reads as 0."""
    return F.when(c.rlike(r"^[+-]?\d+\z"), F.coalesce(c.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def rate_limit_info(df: DataFrame, headers: str = "headers") -> DataFrame:
    """Per response: Retry-After (seconds, fractions allowed, else 0) and the
    rate-limit triple; the info is NULL when no rate-limit header is present
    and Retry-After is 0; unparsable integers read as 0."""
    h = df.select("*", headers_lookup(headers, RATE_LIMIT_HEADERS).alias("_h"))
    ra, lim, rem, rst = (F.col(f"_h.h{i}") for i in range(4))
    # plain decimal or exponent form only: no type suffix, no spaces
    number = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
    secs = F.when(ra.rlike(number), F.coalesce(ra.try_cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    retry_ms = F.when(F.isnan(secs), F.lit(0.0)).otherwise(secs * 1000)
    present = (lim != "") | (rem != "") | (rst != "") | (retry_ms != 0)
    return h.select(
        *[F.col(c) for c in df.columns],
        retry_ms.alias("retry_after_ms"),
        F.when(present, _whole(lim)).alias("rl_limit"),
        F.when(present, _whole(rem)).alias("rl_remaining"),
        F.when(present, _whole(rst)).alias("rl_reset"),
    )


def rate_limit_rollup(responses: DataFrame, width: str = "1 hour", headers: str = "headers") -> DataFrame:
    """Per time window and endpoint: requests, throttled (429) count,
    lowest remaining, latest reset and the longest Retry-After."""
    info = rate_limit_info(responses, headers)
    return info.groupBy(F.window("ts", width).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") == 429).alias("throttled"),
        F.min("rl_remaining").alias("min_remaining"),
        F.max("rl_reset").alias("latest_reset"),
        F.max("retry_after_ms").alias("max_retry_after_ms"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "endpoint",
             "requests", "throttled", "min_remaining", "latest_reset", "max_retry_after_ms")
