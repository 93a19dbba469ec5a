"""Queries for the unique policy (W3), handler processing (X1-X4) and
subscriptions (X5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from jobledger.catalog.registry import register
from jobledger.oracle_views import VIEWS
from jobledger.operators import process as X
from jobledger.operators import projections as P
from jobledger.operators import unique as UQ
from jobledger.plans.stages import StageChain
from jobledger.sources import fixtures as fx
from jobledger.streaming.subscribe import subscribe

DAY_MS = 86_400_000

UNIQUE_SQL = f"""WITH RECURSIVE requests AS ({VIEWS["requests"]}
),
r AS (SELECT unique_key, created_at, request_id,
             row_number() OVER (PARTITION BY unique_key ORDER BY created_at, request_id) AS rn FROM requests),
f AS (
  SELECT unique_key, rn, request_id, created_at, created_at AS anchor, request_id AS anchor_id, true AS opened
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.unique_key, r.rn, r.request_id, r.created_at,
         CASE WHEN r.created_at >= f.anchor + INTERVAL 1 DAY THEN r.created_at ELSE f.anchor END,
         CASE WHEN r.created_at >= f.anchor + INTERVAL 1 DAY THEN r.request_id ELSE f.anchor_id END,
         r.created_at >= f.anchor + INTERVAL 1 DAY
  FROM f JOIN r ON r.unique_key = f.unique_key AND r.rn = f.rn + 1)"""


@register("apply_unique", sql=UNIQUE_SQL + """
SELECT request_id, unique_key, CASE WHEN opened THEN 'accepted' ELSE 'duplicate' END AS status,
       anchor AS slot_anchor, anchor_id AS slot_id FROM f""")
def q_apply_unique(spark, sf):
    r = fx.requests(spark, sf).select("request_id", "unique_key", "created_at")
    out = UQ.apply_unique(r, DAY_MS, "reject", key_col="unique_key")
    return out.select("request_id", "unique_key", "status", "slot_anchor", "slot_id")


@register("unique_survivors", sql=UNIQUE_SQL + """
SELECT anchor_id AS slot_id, arg_max(request_id, rn) AS payload_id, min(created_at) AS run_at, count(*) - 1 AS conflicts
FROM f GROUP BY anchor_id""")
def q_unique_survivors(spark, sf):
    r = fx.requests(spark, sf).select("request_id", "unique_key", "created_at")
    folded = UQ.apply_unique(r, DAY_MS, "replace_except_schedule", key_col="unique_key")
    return UQ.unique_survivors(folded, "replace_except_schedule")


def _unique_with(strategy: str, label: str):
    @register(f"apply_unique_{strategy}", sql=UNIQUE_SQL + f"""
SELECT request_id, CASE WHEN opened THEN 'accepted' ELSE '{label}' END AS status, anchor_id AS slot_id FROM f""")
    def q(spark, sf):
        r = fx.requests(spark, sf).select("request_id", "unique_key", "created_at")
        return UQ.apply_unique(r, DAY_MS, strategy, key_col="unique_key").select("request_id", "status", "slot_id")


for _strategy in ("ignore", "replace", "replace_except_schedule"):
    _unique_with(_strategy, UQ.STATUS[_strategy])


@register("apply_unique_hot_key", views=("requests",), sql="""
, r AS (SELECT request_id, CASE WHEN request_id % 10 < 9 THEN 'hot' ELSE 'cold' END AS k FROM requests)
, first AS (SELECT k, min(request_id) AS slot_id FROM r GROUP BY k)
SELECT r.request_id, CASE WHEN r.request_id = slot_id THEN 'accepted' ELSE 'duplicate' END AS status, slot_id FROM r JOIN first ON r.k = first.k""")
def q_apply_unique_hot_key(spark, sf):
    """Nine tenths of all rows under one key, all of them within one period."""
    r = fx.requests(spark, sf).select(
        "request_id", F.when(F.col("request_id") % 10 < 9, "hot").otherwise("cold").alias("k"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"))
    return UQ.apply_unique(r, DAY_MS, "reject", key_col="k").select("request_id", "status", "slot_id")


# ---- deterministic handlers and middleware used by the processing queries ----

def _h_urgent(job):
    return {"attempt": job["attempt"]}


def _h_high(job):
    if int(job["id"]) % 7 == 0:
        raise X.NonRetryable("bad input")
    return {"ok": True}


def _h_low(job):
    if job["attempt"] > 3:
        raise ValueError("boom")
    return {"queue": job["queue"]}


def _h_medium(job):
    if int(job["id"]) % 2 == 0:
        raise X.JobError("downstream unavailable")
    return None


HANDLERS = {"order.urgent": _h_urgent, "order.high": _h_high, "order.low": _h_low, "order.medium": _h_medium}


def _tag(mark):
    def mw(job, nxt):
        r = nxt(job)
        if isinstance(r, dict):
            r = {**r, "order": mark + r.get("order", "")}
        return r
    return mw


def middleware():
    return StageChain().add(_tag("1"), "outer").add(_tag("2"), "inner")


def _handler_sql(attempt_expr: str, missing_state: str, error_state: str, missing_error: bool) -> str:
    a = attempt_expr
    ok = f"""CASE type WHEN 'order.urgent' THEN true WHEN 'order.high' THEN job_id % 7 <> 0
                       WHEN 'order.low' THEN {a} <= 3 WHEN 'order.medium' THEN job_id % 2 <> 0 END"""
    return f"""
SELECT CAST(job_id AS VARCHAR) AS job_id, type,
       CASE WHEN ({ok}) IS NULL THEN '{missing_state}' WHEN {ok} THEN 'completed' ELSE '{error_state}' END AS state,
       CAST({a} AS INT) AS attempt,
       CASE WHEN ({ok}) IS NULL OR NOT ({ok}) THEN NULL
            WHEN type = 'order.urgent' THEN '{{"attempt":' || CAST({a} AS VARCHAR) || ',"order":"12"}}'
            WHEN type = 'order.high' THEN '{{"ok":true,"order":"12"}}'
            WHEN type = 'order.low' THEN '{{"order":"12","queue":"' || queue || '"}}' END AS result,
       CASE WHEN ({ok}) IS NULL THEN {"'handler_error'" if missing_error else 'NULL'} WHEN NOT ({ok}) THEN 'handler_error' END AS error_code,
       CASE WHEN ({ok}) IS NULL THEN {"'no handler registered for job type \"' || type || '\"'" if missing_error else 'NULL'}
            WHEN NOT ({ok}) THEN CASE type WHEN 'order.high' THEN 'bad input'
                                          WHEN 'order.low' THEN 'panic in job order.low (id=' || CAST(job_id AS VARCHAR) || '): boom'
                                          WHEN 'order.medium' THEN 'downstream unavailable' END END AS error_message"""


@register("process", views=("jobs",), sql=_handler_sql("attempt", "failed", "failed", True) + """,
       CASE WHEN type NOT IN ('order.urgent', 'order.high', 'order.low', 'order.medium') THEN false
            WHEN type = 'order.high' AND job_id % 7 = 0 THEN false
            WHEN (type = 'order.low' AND attempt > 3) OR (type = 'order.medium' AND job_id % 2 = 0) THEN true END AS error_retryable
FROM jobs""")
def q_process(spark, sf):
    jobs = fx.jobs(spark, sf).select("job_id", "type", "queue", "attempt")
    out = X.process(jobs, HANDLERS, middleware=middleware())
    return out.drop("duration_ms")


@register("process_bad_rows", views=("jobs",), sql="""
SELECT CAST(job_id AS VARCHAR) AS job_id, CASE WHEN job_id % 5 IN (1, 2, 3) THEN 'failed' ELSE 'completed' END AS state,
       CASE WHEN job_id % 5 = 0 THEN 0 ELSE attempt END AS attempt,
       CASE WHEN job_id % 5 = 0 THEN '{"a":0}' WHEN job_id % 5 = 4 THEN '{"a":' || CAST(job_id AS VARCHAR) || '}' END AS result,
       CASE WHEN job_id % 5 IN (1, 2, 3) THEN false END AS error_retryable,
       CASE job_id % 5 WHEN 1 THEN 'invalid args' WHEN 2 THEN 'invalid meta' WHEN 3 THEN 'result cannot be encoded' END AS error
FROM jobs""")
def q_process_bad_rows(spark, sf):
    """Rows without an attempt, with text that is no JSON, and with a result
    that cannot be written: each is its own error and fails no task. Args come
    in wire form."""
    k = F.col("job_id") % 5
    jobs = fx.jobs(spark, sf).select(
        "job_id", F.lit("t").alias("type"), F.when(k != 0, F.col("attempt")).alias("attempt"),
        F.when(k == 1, "{broken").otherwise(F.concat(F.lit('[{"a":'), F.when(k == 0, F.lit("0")).otherwise(F.col("job_id").cast("string")), F.lit("}]"))).alias("args"),
        F.when(k == 2, "nope").alias("meta"))
    out = X.process(jobs, {"t": _h_any})
    return out.select("job_id", "state", "attempt", "result", "error_retryable",
                      F.regexp_extract("error_message", r"^(invalid args|invalid meta|result cannot be encoded)", 1).alias("error"))


def _h_any(job):
    return {"a": {1, 2}} if int(job["id"]) % 5 == 3 else job["args"]


@register("drain", views=("jobs",), sql="""
, d AS (""" + _handler_sql("attempt + 1", "completed", "discarded", False) + """, true AS performed
FROM jobs WHERE state = 'available')
SELECT job_id, type, state, attempt, result, error_message, performed FROM d
UNION ALL
SELECT CAST(job_id AS VARCHAR), type, state, attempt, NULL, NULL, false FROM jobs WHERE state <> 'available'""")
def q_drain(spark, sf):
    jobs = fx.jobs(spark, sf).select("job_id", "type", "queue", "attempt", "state")
    return X.drain(jobs, HANDLERS, middleware=middleware())


def _stages():
    p = StageChain()
    p.add(lambda df: df.select("job_id", "type", "queue", "state", "priority"), "project")
    p.add(lambda df: df.filter(F.col("state") != "completed"), "open")
    p.insert_before("open", "validate", P.validate_types)
    p.insert_after("missing", "rank", lambda df: df.withColumn("urgent", F.col("priority") >= 4))
    p.add(lambda df: df.filter(F.lit(False)), "drop-all")
    p.remove("drop-all")
    p.prepend("default-queue", lambda df: df.withColumn("queue", F.coalesce("queue", F.lit("default"))))
    return p


@register("stage_chain", views=("jobs",), sql="""
SELECT job_id, type, queue, state, priority,
       CASE WHEN type IS NULL OR type = '' THEN 'job type is required'
            WHEN NOT regexp_matches(type, '^[a-z][a-z0-9_\\-]*(\\.[a-z][a-z0-9_\\-]*)*\\z')
            THEN 'invalid job type "' || type || '": must match pattern ^[a-z][a-z0-9_-]*(\\.[a-z][a-z0-9_-]*)*$' END AS type_reason,
       priority >= 4 AS urgent
FROM jobs WHERE state <> 'completed'""")
def q_stage_chain(spark, sf):
    return _stages().apply(fx.jobs(spark, sf))


@register("subscribe", views=("job_events",), sql="""
SELECT type, subject, count(*) AS n FROM job_events WHERE type IN ('job.completed', 'job.failed') GROUP BY type, subject""")
def q_subscribe(spark, sf):
    def per_subject(typ):
        return lambda df: df.groupBy("subject").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(typ).alias("type"), "subject", "n")
    res = subscribe(fx.job_events(spark, sf), {t: per_subject(t) for t in ["job.completed", "job.failed"]})
    return reduce(lambda a, b: a.unionByName(b), res.values())
