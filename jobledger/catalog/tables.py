"""Queries for joins (J1-J9), pages (L1-L2) and registries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobledger.catalog.aggregates import EVENTS_AS_OF
from jobledger.catalog.registry import register
from jobledger.operators import aggregations as agg
from jobledger.operators import joins as J
from jobledger.operators import pages as L
from jobledger.operators import projections as P
from jobledger.operators import registry as U
from jobledger.plans.strategy import literal_frame, parts_for
from jobledger.session import checkpoint_dir
from jobledger.sources import fixtures as fx
from jobledger.sources.tables import table

ORDERS_AS_OF = "1998-01-01 00:00:00"
HANDLER_TYPES = ["order.urgent", "order.high", "order.low"]


@register("route", views=("jobs", "handlers"), sql="""
SELECT j.job_id, j.type, h.type IS NOT NULL AS routed,
       CASE WHEN h.type IS NULL THEN 'handler_error' END AS error_code,
       CASE WHEN h.type IS NULL THEN 'no handler registered for job type "' || j.type || '"' END AS error_message,
       CASE WHEN h.type IS NULL THEN false END AS error_retryable
FROM jobs j LEFT JOIN handlers h ON j.type = h.type""")
def q_route(spark, sf):
    handlers = literal_frame(spark, [(t,) for t in HANDLER_TYPES], "type string")
    r = J.route(fx.jobs(spark, sf).select("job_id", "type"), handlers)
    return r.select("job_id", "type", "routed", "error_code", "error_message", "error_retryable")


@register("get_jobs", views=("jobs",), sql="""
SELECT c.c_custkey AS job_id, j.state, j.type, CASE WHEN j.job_id IS NULL THEN 'not_found' END AS error_code
FROM customer c LEFT JOIN jobs j ON c.c_custkey = j.job_id""")
def q_get_jobs(spark, sf):
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"))
    return J.get_jobs(fx.jobs(spark, sf).select("job_id", "state", "type"), ids)


@register("apply_outcomes", views=("jobs", "attempts"), sql="""
, o AS (SELECT job_id, arg_max(outcome, attempt) AS last_outcome, arg_max(error_code, attempt) AS code,
               arg_max(retryable, attempt) AS rty, count(*) AS n FROM attempts GROUP BY job_id)
, t AS (SELECT j.job_id, j.state, j.attempt, j.max_attempts, o.last_outcome, o.code, o.rty, o.n,
               j.state = 'active' AND o.last_outcome = 'completed' AS ack,
               j.state = 'active' AND o.last_outcome IS NOT NULL AND o.last_outcome <> 'completed' AS nack
        FROM jobs j LEFT JOIN o ON j.job_id = o.job_id)
SELECT job_id,
       CASE WHEN ack THEN 'completed' WHEN nack THEN CASE WHEN coalesce(rty, false) AND attempt < max_attempts THEN 'retryable' ELSE 'discarded' END
            ELSE state END AS state,
       CASE WHEN ack THEN '{"attempts":' || CAST(n AS VARCHAR) || '}' END AS result,
       CASE WHEN nack THEN code END AS error_code,
       CASE WHEN nack THEN rty END AS error_retryable
FROM t""")
def q_apply_outcomes(spark, sf):
    a = fx.attempts(spark, sf)
    last = a.groupBy("job_id").agg(
        F.max_by("outcome", "attempt").alias("o"), F.max_by("error_code", "attempt").alias("code"),
        F.max_by("retryable", "attempt").alias("rty"), F.count(F.lit(1)).alias("n"))
    outcomes = last.select(
        "job_id", F.when(F.col("o") == "completed", "ack").otherwise("nack").alias("kind"),
        F.when(F.col("o") == "completed", F.concat(F.lit('{"attempts":'), F.col("n").cast("string"), F.lit("}")))
         .alias("result"),
        F.when(F.col("o") != "completed", F.struct(F.col("code").alias("code"), F.lit("failed").alias("message"),
                                                   F.col("rty").alias("retryable"))).alias("error"))
    # a second, later outcome of every job must not count
    late = outcomes.select("job_id", F.lit("nack").alias("kind"), F.lit(None).cast("string").alias("result"),
                           F.struct(F.lit("late").alias("code"), F.lit("late").alias("message"), F.lit(True).alias("retryable")).alias("error"), F.lit(2).alias("seq"))
    outcomes = outcomes.withColumn("seq", F.lit(1)).unionByName(late)
    jobs = fx.jobs(spark, sf).select("job_id", "state", "attempt", "max_attempts")
    out = J.apply_outcomes(jobs, outcomes)
    return out.select("job_id", "state", "result", F.col("error.code").alias("error_code"),
                      F.col("error.retryable").alias("error_retryable"))


@register("cancel_jobs", views=("jobs",), sql=f"""
SELECT p.p_partkey AS job_id, j.state AS previous_state,
       CASE WHEN j.job_id IS NOT NULL AND j.state NOT IN ('completed', 'cancelled', 'discarded') THEN 'cancelled' ELSE j.state END AS state,
       CASE WHEN j.job_id IS NOT NULL AND j.state NOT IN ('completed', 'cancelled', 'discarded') THEN TIMESTAMP '{ORDERS_AS_OF}' END AS cancelled_at,
       CASE WHEN j.job_id IS NULL THEN 'not_found' WHEN j.state IN ('completed', 'cancelled', 'discarded') THEN 'conflict' END AS error_code
FROM part p LEFT JOIN jobs j ON p.p_partkey = j.job_id""")
def q_cancel_jobs(spark, sf):
    ids = table(spark, sf, "part").select(F.col("p_partkey").alias("job_id"))
    return J.cancel_jobs(fx.jobs(spark, sf), ids, ORDERS_AS_OF)


@register("drop_paused", views=("jobs", "queues"), sql="""
SELECT job_id, queue FROM jobs WHERE queue NOT IN (SELECT queue FROM queues WHERE status = 'paused')""")
def q_drop_paused(spark, sf):
    return J.drop_paused(fx.jobs(spark, sf).select("job_id", "queue"), fx.queues(spark))


@register("ready_steps", views=("batch_steps",), sql="""
, st AS (SELECT DISTINCT workflow_id, step_id, state FROM batch_steps)
, e AS (SELECT a.workflow_id, a.step_id, a.depends_on_id, d.state AS dep_state
        FROM batch_steps a LEFT JOIN st d ON a.workflow_id = d.workflow_id AND a.depends_on_id = d.step_id)
, g AS (SELECT workflow_id, step_id, CAST(count(depends_on_id) AS BIGINT) AS n_deps,
               CAST(count_if(depends_on_id IS NOT NULL AND dep_state = 'completed') AS BIGINT) AS n_done,
               count_if(dep_state IN ('completed', 'cancelled', 'discarded')) AS n_term, count_if(dep_state IN ('cancelled', 'discarded')) AS n_bad
        FROM e GROUP BY workflow_id, step_id)
SELECT workflow_id, step_id, n_deps, n_done,
       CASE step_id WHEN 'on-complete' THEN n_term = n_deps WHEN 'on-failure' THEN n_term = n_deps AND n_bad > 0 ELSE n_done = n_deps END AS ready
FROM g""")
def q_ready_steps(spark, sf):
    return J.ready_steps(fx.batch_steps(spark, sf), parts_for(table(spark, sf, "lineitem")))


@register("parent_results", views=("workflow_steps",), sql="""
SELECT a.workflow_id, a.step_id, a.depends_on_id AS parent_id,
       CASE WHEN d.state = 'completed' THEN 'ok-' || d.step_id END AS parent_result
FROM workflow_steps a LEFT JOIN workflow_steps d ON a.workflow_id = d.workflow_id AND a.depends_on_id = d.step_id
WHERE a.depends_on_id IS NOT NULL""")
def q_parent_results(spark, sf):
    s = fx.workflow_steps(spark, sf)
    s = s.withColumn("result", F.when(F.col("state") == "completed", F.concat(F.lit("ok-"), F.col("step_id"))))
    return J.parent_results(s).select("workflow_id", "step_id", "parent_id", "parent_result")


@register("stale_jobs", views=("heartbeats",), sql=f"""
, j AS (SELECT DISTINCT user_id AS job_id, 3600000 * (user_id % 5 + 1) AS vt FROM events)
, hb AS (SELECT active_job_id AS job_id, max(ts) AS last_heartbeat FROM heartbeats
         WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}' GROUP BY active_job_id)
SELECT j.job_id, hb.last_heartbeat, j.vt AS visibility_timeout_ms,
       hb.last_heartbeat IS NULL OR hb.last_heartbeat < TIMESTAMP '{EVENTS_AS_OF}' - j.vt * INTERVAL 1 MILLISECOND AS reclaimable
FROM j LEFT JOIN hb ON j.job_id = hb.job_id""")
def q_stale_jobs(spark, sf):
    e = table(spark, sf, "events")
    jobs = e.select(F.col("user_id").alias("job_id")).distinct().select(
        "job_id", F.lit("active").alias("state"),
        (F.lit(3600000) * (F.col("job_id") % 5 + 1)).alias("visibility_timeout_ms"))
    return J.stale_jobs(jobs, fx.heartbeats(spark, sf), EVENTS_AS_OF)


PAYLOAD_SCHEMAS = [
    ("evt.signup", "urn:schema:evt.signup:v2", "2",
     '{"type":"object","properties":{"k":{"type":"string"}},"required":["k"]}'),
    ("evt.signup", "urn:schema:evt.signup:v10", "10",
     '{"type":"object","properties":{"k":{"type":"integer"}},"required":["k"]}'),
    ("evt.view", "urn:schema:evt.view:v1", "1",
     '{"type":"object","properties":{"k":{"type":"string"}},"required":["k"]}'),
    ("evt.purchase", "urn:schema:evt.purchase:v1", "1", '{"type":"object","required":["k","to"]}'),
]
_SCHEMA_ROWS = ", ".join(f"('{t}', '{u}', {v}, '{s}')" for t, u, v, s in PAYLOAD_SCHEMAS)


@register("validate_payloads", views=("requests",), sql=f"""
, sch(type, uri, version, spec) AS (VALUES {_SCHEMA_ROWS})
, named AS (SELECT request_id, type, json_extract(args, '$[0]') AS a,
                   CASE WHEN request_id % 5 = 1 THEN 'urn:schema:evt.signup:v2' WHEN request_id % 5 = 2 THEN 'urn:schema:none' END AS want
            FROM requests)
, j AS (SELECT n.*, s.uri, s.spec FROM named n LEFT JOIN sch s ON CASE WHEN n.want IS NOT NULL THEN s.uri = n.want
          ELSE s.type = n.type AND s.version = (SELECT max(x.version) FROM sch x WHERE x.type = n.type) END)
, c AS (SELECT *, CASE WHEN spec IS NOT NULL THEN list_filter(CAST(json_extract(spec, '$.required') AS VARCHAR[]), lambda k: NOT list_contains(json_keys(a), k))[1] END AS missing,
               json_extract_string(spec, '$.properties.k.type') AS expected, json_type(a, '$.k') AS kind FROM j)
, e AS (SELECT *, CASE WHEN want IS NOT NULL AND uri IS NULL THEN 'schema not registered'
                       WHEN missing IS NOT NULL THEN 'missing required field ' || missing
                       WHEN expected = 'string' AND kind <> 'VARCHAR' THEN 'field k: expected string'
                       WHEN expected = 'integer' AND kind NOT IN ('UBIGINT', 'BIGINT') THEN 'field k: expected integer' END AS error_message FROM c)
SELECT request_id, type, uri AS schema_uri_matched, error_message IS NULL AS valid,
       CASE WHEN error_message IS NOT NULL THEN 'schema_validation' END AS error_code, error_message
FROM e""")
def q_validate_payloads(spark, sf):
    """Two versions of one type; some jobs name a version, some an unknown URI."""
    schemas = literal_frame(spark, PAYLOAD_SCHEMAS, "type string, uri string, version string, schema string")
    k = F.col("request_id") % 5
    named = F.when(k == 1, "urn:schema:evt.signup:v2").when(k == 2, "urn:schema:none")
    r = P.decode_args(fx.requests(spark, sf).select("request_id", "type", "args", named.alias("schema_uri")))
    out = J.validate_payloads(r, schemas)
    return out.select("request_id", "type", "schema_uri_matched", "valid", "error_code", "error_message")


def _page_order():
    return [F.col("created_at").desc(), F.col("job_id")]


@register("paginate", views=("jobs",), sql="""
SELECT job_id, created_at, state FROM jobs ORDER BY created_at DESC, job_id LIMIT 50 OFFSET 100""")
def q_paginate(spark, sf):
    page, _ = L.paginate(fx.jobs(spark, sf).select("job_id", "created_at", "state"), _page_order(), 50, 100)
    return page


@register("page_after", views=("jobs",), sql="""
SELECT job_id, created_at, state FROM jobs ORDER BY created_at DESC, job_id LIMIT 40 OFFSET 60""")
def q_page_after(spark, sf):
    """The page after a row, found by the key of that row (here the last of
    the first 60)."""
    j = fx.jobs(spark, sf).select("job_id", "created_at", "state")
    keys = [("created_at", True), ("job_id", False)]
    last = L.page_after(j, keys, 60).agg(F.max_by(F.struct("created_at", "job_id"), F.struct(-F.unix_micros(F.col("created_at").cast("timestamp")), "job_id")).alias("l")).first()["l"]
    return L.page_after(j, keys, 40, {"created_at": last["created_at"], "job_id": last["job_id"]})


@register("page_at", views=("jobs",), sql="""
, r AS (SELECT job_id, created_at, state, row_number() OVER (ORDER BY created_at DESC, job_id) AS rn, count(*) OVER () AS n FROM jobs)
SELECT job_id, created_at, state FROM r WHERE rn > n * 9 // 10 AND rn <= n * 9 // 10 + 50""")
def q_page_at(spark, sf):
    """A page at nine tenths of the table, from the slices that hold it."""
    j = fx.jobs(spark, sf).select("job_id", "created_at", "state")
    keys = [("created_at", True), ("job_id", False)]
    pages = L.write_pages(j, keys, f"{checkpoint_dir(spark)}/pages-{uuid.uuid4().hex}")
    return L.page_at(pages, keys, 50, pages.count() * 9 // 10)


@register("paginate_meta", views=("jobs",), sql="""
SELECT count(*) AS total, 50 AS limit, 100 AS offset, 100 + least(50, greatest(count(*) - 100, 0)) < count(*) AS has_more
FROM jobs""")
def q_paginate_meta(spark, sf):
    _, meta = L.paginate(fx.jobs(spark, sf).select("job_id", "created_at", "state"), _page_order(), 50, 100)
    return meta


@register("list_dead_letter", views=("jobs",), sql="""
SELECT job_id, queue, started_at AS discarded_at FROM jobs
WHERE state = 'discarded' AND queue = 'building'
ORDER BY started_at DESC NULLS LAST, job_id LIMIT 25 OFFSET 10""")
def q_list_dead_letter(spark, sf):
    j = fx.jobs(spark, sf).select("job_id", "queue", "state", F.col("started_at").alias("discarded_at"))
    page, _ = L.list_dead_letter(j, "building", 25, 10)
    return page.select("job_id", "queue", "discarded_at")


@register("apply_dead_letter", views=("jobs",), sql="""
, c AS (SELECT o_orderkey AS job_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'retry' WHEN 1 THEN 'discard' ELSE 'noop' END AS op FROM orders)
SELECT j.job_id, CASE WHEN j.state = 'discarded' AND c.op = 'retry' THEN 'available' ELSE j.state END AS state
FROM jobs j LEFT JOIN c ON j.job_id = c.job_id
WHERE NOT (j.state = 'discarded' AND coalesce(c.op, '') = 'discard')""")
def q_apply_dead_letter(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    cmds = o.select(k.alias("job_id"), F.lit(1).alias("seq"),
                    F.when(k % 3 == 0, "retry").when(k % 3 == 1, "discard").otherwise("noop").alias("op"))
    return U.apply_dead_letter(fx.jobs(spark, sf).select("job_id", "state"), cmds)


@register("compact_registry", sql="""
, l AS (SELECT 'cron-' || CAST(user_id % 20 AS VARCHAR) AS key, event_id AS seq,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'register' END AS op, props AS payload FROM events)
, last AS (SELECT key, arg_max(seq, seq) AS seq, arg_max(op, seq) AS op, arg_max(payload, seq) AS payload FROM l GROUP BY key)
SELECT key, seq, payload FROM last WHERE op <> 'delete'""".replace(", l AS", "WITH l AS", 1))
def q_compact_registry(spark, sf):
    e = table(spark, sf, "events")
    log = e.select(F.concat(F.lit("cron-"), (F.col("user_id") % 20).cast("string")).alias("key"),
                   F.col("event_id").alias("seq"),
                   F.when(F.col("event_type") == "error", "delete").otherwise("register").alias("op"),
                   F.col("props").alias("payload"))
    return U.compact_registry(log)


def _materialise_sql():
    from jobledger.catalog.aggregates import _reason_sql
    return f"""
, chk AS (SELECT *, {_reason_sql()} AS reason FROM requests)
, ok AS (SELECT batch_id FROM chk GROUP BY batch_id HAVING count_if(reason IS NOT NULL) = 0)
, acc AS (SELECT r.* FROM requests r JOIN ok ON r.batch_id = ok.batch_id)
SELECT printf('fake-%06d', row_number() OVER (ORDER BY created_at, request_id)) AS id, request_id, type,
       coalesce(nullif(queue, ''), 'default') AS queue, 'available' AS state, 0 AS attempt
FROM acc"""


@register("materialise_jobs", views=("requests",), sql=_materialise_sql())
def q_materialise_jobs(spark, sf):
    _, accepted = agg.enqueue_batch(fx.requests(spark, sf))
    jobs = U.materialise_jobs(accepted.select("request_id", "type", "queue", "created_at"), prefix="fake-")
    return jobs.select("id", "request_id", "type", "queue", "state", "attempt")
