"""Queries for the aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobledger.catalog.registry import register
from jobledger.functions.timecols import ts_lit
from jobledger.operators import aggregations as agg
from jobledger.sources import fixtures as fx

ORDERS_AS_OF = "1998-01-01 00:00:30"
EVENTS_AS_OF = "2024-01-15 12:00:00"


@register("queue_stats", views=("jobs", "attempts", "queues"), sql=f"""
, by_state AS (
  SELECT queue,
         CAST(count_if(state = 'available') AS BIGINT) AS available,
         CAST(count_if(state = 'active') AS BIGINT) AS active,
         CAST(count_if(state = 'scheduled') AS BIGINT) AS scheduled,
         CAST(count_if(state = 'retryable') AS BIGINT) AS retryable,
         CAST(count_if(state = 'discarded') AS BIGINT) AS discarded
  FROM jobs GROUP BY queue),
att AS (
  SELECT j.queue, a.outcome, a.duration_ms,
         a.started_at + a.duration_ms * INTERVAL 1 MILLISECOND AS finished,
         (epoch_us(a.started_at) - epoch_us(j.created_at)) / 1000.0 AS wait_ms
  FROM attempts a JOIN jobs j ON a.job_id = j.job_id),
by_att AS (
  SELECT queue,
         count_if(outcome = 'completed' AND finished > TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 3600 SECOND
                  AND finished <= TIMESTAMP '{ORDERS_AS_OF}') AS c,
         count_if(outcome = 'failed' AND finished > TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 3600 SECOND
                  AND finished <= TIMESTAMP '{ORDERS_AS_OF}') AS f,
         avg(CASE WHEN outcome = 'completed' THEN duration_ms END) AS d,
         avg(CASE WHEN wait_ms >= 0 THEN wait_ms END) AS w
  FROM att GROUP BY queue)
SELECT coalesce(s.queue, q.queue) AS queue, coalesce(q.status, 'active') AS status, TIMESTAMP '{ORDERS_AS_OF}' AS computed_at,
       coalesce(s.available, 0) AS available, coalesce(s.active, 0) AS active, coalesce(s.scheduled, 0) AS scheduled,
       coalesce(s.retryable, 0) AS retryable, coalesce(s.discarded, 0) AS discarded,
       CAST(coalesce(b.c, 0) AS BIGINT) AS completed_last_hour,
       CAST(coalesce(b.f, 0) AS BIGINT) AS failed_last_hour,
       round(b.d, 6) AS avg_duration_ms, round(b.w, 6) AS avg_wait_ms,
       round(coalesce(b.c, 0) / 3600.0, 6) AS throughput_per_second
FROM by_state s LEFT JOIN by_att b ON s.queue = b.queue FULL JOIN queues q ON s.queue = q.queue""")
def q_queue_stats(spark, sf_dir):
    return agg.queue_stats(fx.jobs(spark, sf_dir), fx.attempts(spark, sf_dir), ORDERS_AS_OF, queues=fx.queues(spark))


@register("list_queues", views=("jobs", "queues"), sql="""
SELECT coalesce(j.queue, q.queue) AS name, coalesce(q.status, 'active') AS status, min(j.created_at) AS created_at, count(j.job_id) AS jobs
FROM jobs j FULL JOIN queues q ON j.queue = q.queue GROUP BY coalesce(j.queue, q.queue), q.status""")
def q_list_queues(spark, sf):
    return agg.list_queues(fx.jobs(spark, sf), fx.queues(spark))


def _bucket_sql():
    from jobledger.constants import DURATION_BUCKETS_MS as E
    parts, prev = [], None
    for e in E:
        cond = f"d <= {e}" if prev is None else f"d > {prev} AND d <= {e}"
        parts.append(f"CAST(count_if({cond}) AS BIGINT) AS bucket_le_{e}")
        prev = e
    parts.append(f"CAST(count_if(d > {prev}) AS BIGINT) AS bucket_inf")
    return ",\n       ".join(parts)


@register("job_metrics", views=("attempts", "jobs"), sql=f"""
, t AS (SELECT j.type, j.queue, a.outcome, floor(a.duration_ms * 1000) / 1000.0 AS d
        FROM attempts a JOIN jobs j ON a.job_id = j.job_id)
SELECT type, queue, count(*) AS started,
       CAST(count_if(outcome = 'completed') AS BIGINT) AS completed,
       CAST(count_if(outcome <> 'completed') AS BIGINT) AS failed,
       round(sum(d), 6) AS duration_sum_ms, count(d) AS duration_count,
       min(d) AS duration_min_ms, max(d) AS duration_max_ms,
       {_bucket_sql()}
FROM t GROUP BY type, queue""")
def q_job_metrics(spark, sf):
    a = fx.attempts(spark, sf).join(fx.jobs(spark, sf).select("job_id", "type", "queue"), "job_id")
    return agg.job_metrics(a)


SKETCH_FROM, SKETCH_TO = "1994-03-05 00:00:00", "1996-07-09 00:00:00"
SKETCH_QUANTILES = [0.05, 0.5, 0.9, 0.99]


@register("duration_quantiles", views=("attempts", "jobs"), sql=f"""
, t AS (SELECT j.type, j.queue, a.duration_ms + (a.job_id % 997) AS d FROM attempts a JOIN jobs j ON a.job_id = j.job_id
        WHERE a.started_at >= TIMESTAMP '{SKETCH_FROM}' AND a.started_at < TIMESTAMP '{SKETCH_TO}')
SELECT type, queue, count(*) AS n, q AS quantile, true AS within
FROM t, (SELECT unnest({SKETCH_QUANTILES}::DOUBLE[]) AS q) GROUP BY type, queue, q""")
def q_duration_quantiles(spark, sf):
    """Sketches a day, merged over more than two years; ``within`` holds each
    quantile's rank against the exact ranks of all durations (1 %)."""
    a = fx.attempts(spark, sf).join(fx.jobs(spark, sf).select("job_id", "type", "queue"), "job_id")
    a = a.select("type", "queue", "started_at", (F.col("duration_ms") + F.col("job_id") % 997).alias("duration_ms"))
    q = agg.duration_quantiles(agg.duration_sketches(a, "day"), SKETCH_QUANTILES, SKETCH_FROM, SKETCH_TO)
    exact = a.filter((F.col("started_at") >= ts_lit(SKETCH_FROM)) & (F.col("started_at") < ts_lit(SKETCH_TO)))
    j = exact.join(q.withColumnRenamed("duration_ms", "_v"), ["type", "queue"])
    slack = F.greatest(F.lit(1.0), F.col("n") * 0.01)
    g = j.groupBy("type", "queue", "n", "quantile").agg(F.count_if(F.col("duration_ms") < F.col("_v")).alias("_lo"),
                                                       F.count_if(F.col("duration_ms") <= F.col("_v")).alias("_hi"))
    at = F.col("quantile") * F.col("n")
    return g.select("type", "queue", "n", "quantile", ((F.col("_lo") <= at + slack) & (F.col("_hi") >= at - slack)).alias("within"))


@register("describe_jobs", views=("jobs",), sql="SELECT type, count(*) AS n FROM jobs GROUP BY type")
def q_describe_jobs(spark, sf):
    return agg.describe_jobs(fx.jobs(spark, sf))


EXPECT_SPECS = [
    {"name": "some urgent", "kind": "enqueued", "type": "order.urgent"},
    {"name": "exact building low", "kind": "enqueued", "type": "order.low", "queue": "building", "count": 3},
    {"name": "no unknown", "kind": "refute", "type": "order.unknown"},
    {"name": "no high in machinery", "kind": "refute", "type": "order.high", "queue": "machinery"},
    {"name": "performed medium", "kind": "performed", "type": "order.medium"},
]


@register("expect_jobs", views=("jobs",), sql="""
, c AS (SELECT count_if(type = 'order.urgent') AS s0,
               count_if(type = 'order.low' AND queue = 'building') AS s1,
               count_if(type = 'order.unknown') AS s2,
               count_if(type = 'order.high' AND queue = 'machinery') AS s3,
               count_if(type = 'order.medium' AND attempt > 0) AS s4 FROM jobs)
SELECT 'some urgent' AS spec, 'enqueued' AS kind, CAST(0 AS BIGINT) AS expected, CAST(s0 AS BIGINT) AS found, s0 >= 1 AS passed FROM c
UNION ALL SELECT 'exact building low', 'enqueued', 3, CAST(s1 AS BIGINT), s1 = 3 FROM c
UNION ALL SELECT 'no unknown', 'refute', 0, CAST(s2 AS BIGINT), s2 = 0 FROM c
UNION ALL SELECT 'no high in machinery', 'refute', 0, CAST(s3 AS BIGINT), s3 = 0 FROM c
UNION ALL SELECT 'performed medium', 'performed', 0, CAST(s4 AS BIGINT), s4 >= 1 FROM c""")
def q_expect_jobs(spark, sf):
    return agg.expect_jobs(fx.jobs(spark, sf), EXPECT_SPECS)


def _reason_sql():
    from jobledger.catalog.projections import QUEUE_REASON_SQL, TYPE_REASON_SQL
    return f"coalesce({TYPE_REASON_SQL}, {QUEUE_REASON_SQL})"


BATCH_SQL = f"""
, chk AS (SELECT *, {_reason_sql()} AS reason FROM requests)
, b AS (SELECT batch_id, count(*) AS n_jobs, count_if(reason IS NOT NULL) AS n_invalid,
               arg_min(reason, CASE WHEN reason IS NOT NULL THEN seq END) AS first_reason,
               min(CASE WHEN reason IS NOT NULL THEN seq END) AS first_seq
        FROM chk GROUP BY batch_id)"""


@register("enqueue_batch", views=("requests",), sql=BATCH_SQL + """
SELECT batch_id, n_jobs, n_invalid = 0 AS accepted,
       CASE WHEN n_invalid > 0 THEN 'job[' || CAST(first_seq AS VARCHAR) || ']: ' || first_reason END AS error
FROM b""")
def q_enqueue_batch(spark, sf):
    return agg.enqueue_batch(fx.requests(spark, sf))[0]


@register("enqueue_batch_accepted", views=("requests",), sql=BATCH_SQL + """
SELECT r.request_id, r.batch_id, r.type, r.queue FROM requests r JOIN b ON r.batch_id = b.batch_id WHERE b.n_invalid = 0""")
def q_enqueue_batch_accepted(spark, sf):
    return agg.enqueue_batch(fx.requests(spark, sf))[1].select("request_id", "batch_id", "type", "queue")


def _errors(spark, sf):
    from pyspark.sql import functions as F
    r = fx.api_responses(spark, sf).filter(F.col("status") >= 400)
    return r.select("event_id", "status", "code", "retryable",
                    F.concat(F.lit("HTTP "), F.col("status").cast("string"), F.lit(" for event "),
                             F.col("event_id").cast("string")).alias("message"),
                    F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("req-"), F.col("event_id").cast("string")))
                     .alias("request_id"))


@register("error_rollup", views=("api_responses",), sql="""
, e AS (SELECT event_id, status, code, retryable,
               'HTTP ' || CAST(status AS VARCHAR) || ' for event ' || CAST(event_id AS VARCHAR) AS message,
               CASE WHEN event_id % 2 = 0 THEN 'req-' || CAST(event_id AS VARCHAR) END AS request_id
        FROM api_responses WHERE status >= 400)
, t AS (SELECT *,
          CASE code WHEN 'not_found' THEN 'not_found' WHEN 'duplicate' THEN 'duplicate' WHEN 'queue_paused' THEN 'queue_paused'
                    WHEN 'rate_limited' THEN 'rate_limited' WHEN 'backend_error' THEN 'backend' WHEN 'timeout' THEN 'timeout'
                    ELSE CASE WHEN status = 409 THEN 'conflict' END END AS error_class,
          CASE WHEN coalesce(request_id, '') <> ''
               THEN coalesce(code, '') || ': ' || coalesce(message, '') || ' (request_id=' || request_id || ')'
               ELSE coalesce(code, '') || ': ' || coalesce(message, '') END AS txt
        FROM e)
SELECT code, error_class, retryable, count(*) AS n, arg_min(txt, event_id) AS sample
FROM t GROUP BY code, error_class, retryable""")
def q_error_rollup(spark, sf):
    return agg.error_rollup(_errors(spark, sf))


@register("worker_load", views=("heartbeats",), sql=r"""
, w AS (SELECT worker_id, max(ts) AS last_seen, count(*) AS heartbeats, CAST(arg_max(event_id % 13, (ts, event_id)) AS INT) AS active FROM heartbeats GROUP BY worker_id)
SELECT worker_id, last_seen, heartbeats, active, greatest(10 - active, 0) AS free_capacity,
       CASE WHEN active >= 10 THEN 0 ELSE greatest(10 - active, 1) END AS fetch_count,
       nullif(regexp_extract(worker_id, '^worker_(.*)_(\d+)_(\d+)\z', 1), '') AS host,
       CAST(nullif(regexp_extract(worker_id, '^worker_(.*)_(\d+)_(\d+)\z', 2), '') AS BIGINT) AS pid,
       CAST(nullif(regexp_extract(worker_id, '^worker_(.*)_(\d+)_(\d+)\z', 3), '') AS BIGINT) AS started_ns
FROM w""")
def q_worker_load(spark, sf):
    from pyspark.sql import functions as F
    held = F.expr("array_repeat(user_id, cast(event_id % 13 as int))")
    hb = fx.heartbeats(spark, sf).withColumn("user_id", F.col("active_job_ids")[0]).withColumn("active_job_ids", held)
    return agg.worker_load(hb, concurrency=10)


def _responses_with_headers(spark, sf):
    from pyspark.sql import functions as F
    r = fx.api_responses(spark, sf)
    st = F.col("status")
    ra = (F.when(st == 429, F.round(F.col("value") / 10, 1).cast("string"))
           .when(st == 500, F.lit("Wed, 21 Oct 2015 07:28:00 GMT")))
    rem = F.when(st.isin(429, 200), (F.floor("value").cast("bigint") % 100).cast("string"))
    lim = F.when(st.isin(429, 200), F.lit("100"))
    rst = F.when(st == 429, (F.lit(1704067200) + F.col("event_id")).cast("string")).when(st == 200, F.lit("soon"))
    headers = F.map_filter(F.create_map(F.lit("Retry-After"), ra, F.lit("x-ratelimit-remaining"), rem,
                                        F.lit("X-RateLimit-Limit"), lim, F.lit("X-RateLimit-Reset"), rst),
                           lambda k, v: v.isNotNull())
    endpoint = F.when(st.isin(429, 500), F.lit("/jobs")).otherwise(F.lit("/queues"))
    return r.select("event_id", "ts", "status", endpoint.alias("endpoint"), headers.alias("headers"))


@register("rate_limit_rollup", views=("api_responses",), sql="""
, h AS (SELECT ts, status, CASE WHEN status IN (429, 500) THEN '/jobs' ELSE '/queues' END AS endpoint,
               CASE WHEN status = 429 THEN CAST(round(value / 10, 1) AS VARCHAR) WHEN status = 500 THEN 'Wed, 21 Oct 2015 07:28:00 GMT' ELSE '' END AS ra,
               CASE WHEN status IN (429, 200) THEN CAST(CAST(floor(value) AS BIGINT) % 100 AS VARCHAR) ELSE '' END AS rem,
               CASE WHEN status IN (429, 200) THEN '100' ELSE '' END AS lim,
               CASE WHEN status = 429 THEN CAST(1704067200 + event_id AS VARCHAR) WHEN status = 200 THEN 'soon' ELSE '' END AS rst
        FROM api_responses)
, i AS (SELECT *, coalesce(TRY_CAST(ra AS DOUBLE), 0.0) * 1000 AS retry_after_ms FROM h)
, p AS (SELECT *, lim <> '' OR rem <> '' OR rst <> '' OR retry_after_ms <> 0 AS present FROM i)
, x AS (SELECT ts, status, endpoint, retry_after_ms,
               CASE WHEN present THEN coalesce(TRY_CAST(rem AS BIGINT), 0) END AS rl_remaining,
               CASE WHEN present THEN coalesce(TRY_CAST(rst AS BIGINT), 0) END AS rl_reset,
               make_timestamp(CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) * 3600000000) AS window_start
        FROM p)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, endpoint, count(*) AS requests,
       CAST(count_if(status = 429) AS BIGINT) AS throttled, min(rl_remaining) AS min_remaining,
       max(rl_reset) AS latest_reset, max(retry_after_ms) AS max_retry_after_ms
FROM x GROUP BY window_start, endpoint""")
def q_rate_limit_rollup(spark, sf):
    return agg.rate_limit_rollup(_responses_with_headers(spark, sf), "1 hour")
