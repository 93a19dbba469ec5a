
from __future__ import annotations


from pyspark.sql import functions as F

from jobledger.catalog.aggregates import _reason_sql
from jobledger.catalog.registry import register
from jobledger.catalog.workflows import _definitions
from jobledger.oracle_views import VIEWS
from jobledger.plans import flows
from jobledger.plans.strategy import parts_for
from jobledger.sources import fixtures as fx
from jobledger.sources.tables import table


def _submit_sql():
    return f"""WITH RECURSIVE requests AS ({VIEWS["requests"]}
),
chk AS (SELECT *, {_reason_sql()} AS reason FROM requests),
ok AS (SELECT batch_id FROM chk GROUP BY batch_id HAVING count_if(reason IS NOT NULL) = 0),
acc AS (SELECT r.*, printf('job-%06d', row_number() OVER (ORDER BY r.created_at, r.request_id)) AS id,
               r.type || '|{{"k":' || CAST(json_extract(r.args, '$[0].k') AS VARCHAR) || '}}' AS ukey
        FROM (SELECT *, CASE WHEN request_id % 4 = 0 AND NOT (request_id % 3 = 0 AND request_id % 8 = 0) THEN created_at + INTERVAL 1 DAY
                             WHEN request_id % 3 = 0 THEN created_at + delay_ms * INTERVAL 1 MILLISECOND END AS run_at FROM requests) r
        JOIN ok ON r.batch_id = ok.batch_id),
rr AS (SELECT ukey, created_at, request_id,
              row_number() OVER (PARTITION BY ukey ORDER BY created_at, request_id) AS rn FROM acc),
f AS (
  SELECT ukey, rn, request_id, created_at, created_at AS anchor, request_id AS anchor_id, true AS opened
  FROM rr WHERE rn = 1
  UNION ALL
  SELECT rr.ukey, rr.rn, rr.request_id, rr.created_at,
         CASE WHEN rr.created_at >= f.anchor + INTERVAL 1 DAY THEN rr.created_at ELSE f.anchor END,
         CASE WHEN rr.created_at >= f.anchor + INTERVAL 1 DAY THEN rr.request_id ELSE f.anchor_id END,
         rr.created_at >= f.anchor + INTERVAL 1 DAY
  FROM f JOIN rr ON rr.ukey = f.ukey AND rr.rn = f.rn + 1)
SELECT a.id, a.request_id, coalesce(nullif(a.queue, ''), 'default') AS queue, a.ukey AS unique_key, a.run_at,
       CASE WHEN a.run_at > a.created_at THEN 'scheduled' ELSE 'available' END AS state,
       '{{' || concat_ws(',', CASE WHEN a.queue <> '' THEN '"queue":"' || a.queue || '"' END,
          CASE WHEN a.run_at IS NOT NULL THEN '"delay_until":"' || strftime(a.run_at, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN epoch_us(a.run_at) % 1000000 = 0 THEN '' ELSE '.' || rtrim(printf('%06d', epoch_us(a.run_at) % 1000000), '0') END || 'Z"' END) || '}}' AS wire_options,
       CASE WHEN f.opened THEN 'accepted' ELSE 'duplicate' END AS unique_status, f.anchor_id AS slot_id
FROM acc a JOIN f ON a.request_id = f.request_id"""


@register("submit_requests", sql=_submit_sql())
def q_submit_requests(spark, sf):
    """Submit flow: args decoded, batches validated, accepted requests given
    job ids, duplicates resolved by a one-day unique policy on args field k."""
    req = fx.requests(spark, sf).drop("unique_key")
    rid = F.col("request_id")
    # some give a delay, some an absolute time, some both: the one given last counts
    req = req.withColumns({"delay_pos": F.when(rid % 3 == 0, 2), "scheduled_at": F.when(rid % 4 == 0, F.col("created_at") + F.expr("INTERVAL 1 DAY")),
                           "scheduled_pos": F.when(rid % 4 == 0, F.when(rid % 8 == 0, 1).otherwise(3))})
    jobs, _ = flows.submit_requests(req, unique_period_ms=86_400_000, unique_fields=["k"])
    return jobs.select("id", "request_id", "queue", "unique_key", "run_at", "state", "wire_options", "unique_status", "slot_id")


def _create_sql():
    from jobledger.catalog.registry import ORACLE
    return f"""WITH g1 AS (
{ORACLE["expand_workflows"]}
)
SELECT workflow_id, step_id, depends_on = '' AND step_id <> 'on-failure' AS ready FROM g1"""


@register("create_workflows", sql=_create_sql())
def q_create_workflows(spark, sf):
    """Workflow flow: definitions expanded, readiness of every (pending) step."""
    _, ready, _ = flows.create_workflows(_definitions(spark, sf), parts_for(table(spark, sf, "lineitem")))
    return ready.select("workflow_id", "step_id", "ready")


ROUND_AS_OF = "1998-01-01 00:00:00"


@register("run_jobs", views=("jobs", "queues"), sql=f"""
, c AS (SELECT j.* FROM jobs j JOIN queues q ON j.queue = q.queue WHERE j.state = 'available' AND coalesce(q.status, 'active') <> 'paused')
, picked AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY queue ORDER BY priority DESC, created_at, job_id) AS rk
                            FROM c) WHERE rk <= 20)
, h AS (SELECT job_id, type, queue, attempt + 1 AS a,
               CASE type WHEN 'order.urgent' THEN true WHEN 'order.high' THEN job_id % 7 <> 0
                         WHEN 'order.low' THEN attempt + 1 <= 3 WHEN 'order.medium' THEN job_id % 2 <> 0 END AS ok
        FROM picked)
, o AS (SELECT *, CASE WHEN ok IS NULL THEN false WHEN ok THEN NULL WHEN type = 'order.high' THEN false ELSE true END AS rty,
               CASE WHEN ok AND type = 'order.urgent' THEN '{{"attempt":' || CAST(a AS VARCHAR) || ',"order":"12"}}'
                    WHEN ok AND type = 'order.high' THEN '{{"ok":true,"order":"12"}}'
                    WHEN ok AND type = 'order.low' THEN '{{"order":"12","queue":"' || queue || '"}}' END AS res
        FROM h)
, s AS (SELECT CAST(j.job_id AS VARCHAR) AS job_id,
               CASE WHEN o.job_id IS NULL THEN j.state WHEN o.ok THEN 'completed'
                    WHEN o.rty AND o.a < j.max_attempts THEN 'retryable' ELSE 'discarded' END AS state,
               coalesce(o.a, j.attempt) AS attempt, o.res AS result
        FROM jobs j LEFT JOIN o ON j.job_id = o.job_id)
SELECT job_id, state, attempt, result,
       CASE WHEN state = 'retryable'
            THEN TIMESTAMP '{ROUND_AS_OF}' + CAST(floor(least(300000.0, 1000.0 * pow(2.0, attempt - 1))) AS BIGINT) * INTERVAL 1 MILLISECOND
       END AS next_run_at
FROM s""")
def q_run_jobs(spark, sf):
    """Run flow: paused queues dropped, top 20 available jobs per queue
    dispatched, routed, run through the middleware-wrapped handlers, acked or
    nacked, retries scheduled with the default policy."""
    from jobledger.catalog.processing import HANDLERS, middleware
    jobs = fx.jobs(spark, sf)
    out = flows.run_jobs(jobs, fx.queues(spark), HANDLERS, per_queue=20, middleware=middleware(), as_of=ROUND_AS_OF)
    return out.select("job_id", "state", "attempt", "result", "next_run_at")
