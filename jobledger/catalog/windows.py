"""Queries for window functions and ordered folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobledger.catalog.aggregates import EVENTS_AS_OF
from jobledger.catalog.registry import register
from jobledger.operators import windows as W
from jobledger.sources import fixtures as fx

DISPATCH_SQL = """
, c AS (SELECT j.job_id, j.queue, j.priority, j.created_at, q.ord FROM jobs j JOIN queues q ON j.queue = q.queue
        WHERE j.state = 'available' AND coalesce(q.status, 'active') <> 'paused')"""


@register("dispatch", views=("jobs", "queues"), sql=DISPATCH_SQL + """
SELECT job_id, queue, priority, created_at FROM c ORDER BY ord, priority DESC, created_at, job_id LIMIT 100""")
def q_dispatch(spark, sf):
    j = fx.jobs(spark, sf).select("job_id", "queue", "priority", "created_at", "state")
    return W.dispatch(j, fx.queues(spark), 100).select("job_id", "queue", "priority", "created_at")


@register("dispatch_per_queue", views=("jobs", "queues"), sql=DISPATCH_SQL + """
SELECT * FROM (
  SELECT job_id, queue, priority, created_at,
         CAST(row_number() OVER (PARTITION BY queue ORDER BY priority DESC, created_at, job_id) AS INT) AS rank FROM c)
WHERE rank <= 20""")
def q_dispatch_per_queue(spark, sf):
    j = fx.jobs(spark, sf).select("job_id", "queue", "priority", "created_at", "state")
    return W.dispatch(j, fx.queues(spark), 20, per_queue=True).select(
        "job_id", "queue", "priority", "created_at", "rank")


RETRY_POLICY = {"max_attempts": 5, "initial_interval_ms": 1000, "backoff_coefficient": 2.0,
                "max_interval_ms": 60000, "jitter": False, "non_retryable_errors": ["invalid_"]}


@register("retry_plan", views=("attempts",), sql="""
, l AS (SELECT job_id, max(attempt) AS n, arg_max(outcome, attempt) AS outcome, arg_max(error_code, attempt) AS code,
               arg_max(retryable, attempt) AS rty, arg_max(started_at, attempt) AS started_at,
               arg_max(duration_ms, attempt) AS duration_ms FROM attempts GROUP BY job_id)
, d AS (SELECT *, CASE WHEN outcome = 'completed' THEN 'none'
                       WHEN NOT coalesce(rty, false) OR starts_with(coalesce(code, ''), 'invalid_') OR n >= 5 THEN 'discard'
                       ELSE 'retry' END AS decision,
               CAST(floor(least(60000.0, 1000.0 * pow(2.0, n - 1))) AS BIGINT) AS dly FROM l)
SELECT job_id, n AS attempt, decision,
       CASE WHEN decision = 'retry' THEN dly END AS delay_ms,
       CASE WHEN decision = 'retry' THEN started_at + duration_ms * INTERVAL 1 MILLISECOND + dly * INTERVAL 1 MILLISECOND END AS next_run_at
FROM d""")
def q_retry_plan(spark, sf):
    return W.retry_plan(fx.attempts(spark, sf), RETRY_POLICY)


@register("retry_plan_jitter", views=("attempts",), sql="""
, l AS (SELECT job_id, max(attempt) AS n, arg_max(outcome, attempt) AS outcome, arg_max(retryable, attempt) AS rty,
               arg_max(started_at, attempt) AS started_at, arg_max(duration_ms, attempt) AS duration_ms FROM attempts GROUP BY job_id)
, d AS (SELECT *, CASE WHEN outcome = 'completed' THEN 'none' WHEN NOT coalesce(rty, false) OR n >= 6 THEN 'discard' ELSE 'retry' END AS decision,
               CAST(floor(least(300000.0, 1000.0 * pow(2.0, n - 1)) * (0.5 + 0.5 * (
                 CAST('0x' || substr(md5(CAST(job_id AS VARCHAR) || ':' || CAST(n AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0))) AS BIGINT) AS dly FROM l)
SELECT job_id, n AS attempt, decision, CASE WHEN decision = 'retry' THEN dly END AS delay_ms,
       CASE WHEN decision = 'retry' THEN started_at + duration_ms * INTERVAL 1 MILLISECOND + dly * INTERVAL 1 MILLISECOND END AS next_run_at
FROM d""")
def q_retry_plan_jitter(spark, sf):
    """The default policy (jitter on) but for the number of attempts."""
    return W.retry_plan(fx.attempts(spark, sf), {"max_attempts": 6})


@register("fetch_backoff", views=("polls",), sql="""
, f AS (SELECT *, CAST(sum(CAST(failed AS INT)) OVER w AS BIGINT) AS fails FROM polls WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, g AS (SELECT *, max(CASE WHEN NOT failed THEN fails END) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS at_s FROM f)
, s AS (SELECT *, fails - coalesce(at_s, 0) AS streak FROM g)
SELECT worker, event_id, ts, failed,
       CASE WHEN failed THEN streak END AS streak,
       CASE WHEN failed THEN CAST(CASE WHEN streak <= 1 THEN 1000 ELSE least(1000 * (CAST(1 AS BIGINT) << least(streak - 1, 10)), 30000) END AS BIGINT) END AS backoff_ms
FROM s""")
def q_fetch_backoff(spark, sf):
    return W.fetch_backoff(fx.polls(spark, sf), base_ms=1000)


@register("worker_state", views=("directives",), sql="""
SELECT worker, event_id, ts, desired,
       CASE WHEN max(CASE WHEN desired = 'terminate' THEN 1 ELSE 0 END) OVER w = 1 THEN 'terminate'
            ELSE coalesce(last_value(CASE WHEN desired IN ('running', 'quiet') THEN desired END IGNORE NULLS) OVER w, 'running') END AS state
FROM directives
WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_worker_state(spark, sf):
    return W.worker_state(fx.directives(spark, sf))


EVENT_STATE_SQL = """CASE type WHEN 'job.enqueued' THEN 'available' WHEN 'job.scheduled' THEN 'scheduled' WHEN 'job.started' THEN 'active'
      WHEN 'job.completed' THEN 'completed' WHEN 'job.failed' THEN 'retryable' WHEN 'job.retrying' THEN 'retryable'
      WHEN 'job.cancelled' THEN 'cancelled' WHEN 'job.discarded' THEN 'discarded' WHEN 'job.expired' THEN 'discarded' END"""


@register("current_state", views=("job_events",), sql=f"""
, s AS (SELECT subject, event_id, time, {EVENT_STATE_SQL} AS state FROM job_events)
, r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY time DESC, event_id DESC) AS rn
        FROM s WHERE state IS NOT NULL AND time <= TIMESTAMP '{EVENTS_AS_OF}')
SELECT subject, state, time AS since, event_id FROM r WHERE rn = 1""")
def q_current_state(spark, sf):
    return W.current_state(fx.job_events(spark, sf), EVENTS_AS_OF)


TIMELINE_SQL = f"""
, s AS (SELECT subject, event_id, time, {EVENT_STATE_SQL} AS state FROM job_events)
, t AS (SELECT subject, event_id, state, time AS start,
               lead(time) OVER (PARTITION BY subject ORDER BY time, event_id) AS "end"
        FROM s WHERE state IS NOT NULL)"""


@register("state_timeline", views=("job_events",), sql=TIMELINE_SQL + """
SELECT subject, event_id, state, start, "end", (epoch_us("end") - epoch_us(start)) / 1000.0 AS duration_ms FROM t""")
def q_state_timeline(spark, sf):
    return W.state_timeline(fx.job_events(spark, sf))


@register("time_in_state", views=("job_events",), sql=TIMELINE_SQL + """
SELECT subject, state, round(sum((epoch_us("end") - epoch_us(start)) / 1000.0), 6) AS total_ms, count(*) AS intervals
FROM t GROUP BY subject, state""")
def q_time_in_state(spark, sf):
    t = W.time_in_state(W.state_timeline(fx.job_events(spark, sf)))
    return t.withColumn("total_ms", F.round("total_ms", 6))


PEAK_SQL = """
, ev AS (SELECT worker_id, started_at AS ts, 1 AS delta FROM attempts
         UNION ALL SELECT worker_id, started_at + duration_ms * INTERVAL 1 MILLISECOND, -1 FROM attempts)
, r AS (SELECT *, CAST(sum(delta) OVER (PARTITION BY worker_id ORDER BY ts, delta ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS active FROM ev)
, p AS (SELECT worker_id, max(active) AS peak_active, count(*) AS changes FROM r GROUP BY worker_id)
SELECT p.worker_id, p.peak_active, min(r.ts) AS peak_at, p.changes
FROM p JOIN r ON p.worker_id = r.worker_id AND r.active = p.peak_active
GROUP BY p.worker_id, p.peak_active, p.changes"""
PEAK_GLOBAL_SQL = """
, ev AS (SELECT started_at AS ts, 1 AS delta FROM attempts
         UNION ALL SELECT started_at + duration_ms * INTERVAL 1 MILLISECOND, -1 FROM attempts)
, r AS (SELECT *, CAST(sum(delta) OVER (ORDER BY ts, delta ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS active FROM ev)
SELECT max(active) AS peak_active, min(ts) FILTER (WHERE active = (SELECT max(active) FROM r)) AS peak_at, count(*) AS changes FROM r"""


@register("active_over_time", views=("attempts",), sql=PEAK_SQL)
def q_active_over_time(spark, sf):
    tl = W.active_over_time(fx.attempts(spark, sf), by="worker_id")
    return W.peak_concurrency(tl, by="worker_id")


@register("active_over_time_global", views=("attempts",), sql=PEAK_GLOBAL_SQL)
def q_active_over_time_global(spark, sf):
    tl = W.active_over_time(fx.attempts(spark, sf), by=None)
    return W.peak_concurrency(tl, by=None)


@register("peak_concurrency", views=("attempts",), sql=PEAK_SQL)
def q_peak_concurrency(spark, sf):
    return W.peak_active(fx.attempts(spark, sf), by="worker_id")


@register("peak_concurrency_global", views=("attempts",), sql=PEAK_GLOBAL_SQL)
def q_peak_concurrency_global(spark, sf):
    return W.peak_active(fx.attempts(spark, sf), by=None)
