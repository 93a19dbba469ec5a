"""Queries for projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobledger.catalog.registry import register
from jobledger.functions import args as A
from jobledger.operators import projections as P
from jobledger.sources import fixtures as fx
from jobledger.sources.tables import table

ORDERS_AS_OF = "1998-01-01 00:00:00"

TYPE_REASON_SQL = r"""CASE WHEN type IS NULL OR type = '' THEN 'job type is required'
      WHEN strlen(type) > 255 THEN printf('job type must not exceed 255 characters, got %d', strlen(type))
      WHEN NOT regexp_matches(type, '^[a-z][a-z0-9_\-]*(\.[a-z][a-z0-9_\-]*)*\z')
      THEN 'invalid job type "' || replace(replace(replace(replace(type, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t')
           || '": must match pattern ^[a-z][a-z0-9_-]*(\.[a-z][a-z0-9_-]*)*$' END"""
QUEUE_REASON_SQL = r"""CASE WHEN queue IS NULL OR queue = '' THEN NULL
      WHEN strlen(queue) > 128 THEN printf('queue name must not exceed 128 characters, got %d', strlen(queue))
      WHEN NOT regexp_matches(queue, '^[a-z0-9][a-z0-9\-\.]*\z')
      THEN 'invalid queue name "' || replace(replace(replace(replace(queue, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t')
           || '": must match pattern ^[a-z0-9][a-z0-9\-\.]*$' END"""


@register("validate_types", views=("requests",),
          sql=f"SELECT request_id, type, {TYPE_REASON_SQL} AS type_reason FROM requests")
def q_validate_types(spark, sf):
    return P.validate_types(fx.requests(spark, sf)).select("request_id", "type", "type_reason")


@register("validate_queues", views=("requests",),
          sql=f"SELECT request_id, queue, {QUEUE_REASON_SQL} AS queue_reason FROM requests")
def q_validate_queues(spark, sf):
    return P.validate_queues(fx.requests(spark, sf)).select("request_id", "queue", "queue_reason")


@register("split_terminal", views=("jobs",), sql="""
SELECT job_id, state, state IN ('completed', 'cancelled', 'discarded') AS terminal FROM jobs""")
def q_split_terminal(spark, sf):
    return P.mark_terminal(fx.jobs(spark, sf).select("job_id", "state"))


def _option_requests(spark, sf):
    r = fx.requests(spark, sf)
    return r.select(
        "request_id",
        F.when(F.col("seq") == 3, F.lit(None)).otherwise(F.col("queue")).alias("queue"),
        (F.col("seq").cast("int") - 5).alias("priority"),
        F.floor((F.col("delay_ms") / 1000 - 150) * 12345).cast("bigint").alias("timeout_us"),
        F.when(F.col("seq") < 5, F.col("delay_ms") * 1000 + F.col("seq")).alias("visibility_timeout_us"),
        F.when(F.col("seq") % 3 == 0, F.timestamp_seconds(1_700_000_000 + F.col("request_id"))).alias("delay_until"),
        F.when(F.col("seq") % 4 == 0, F.timestamp_millis(1_700_000_000_500 + F.col("request_id") * 1000)).alias("expires_at"),
        F.when(F.col("seq") % 2 == 0, F.struct(
            F.col("seq").cast("int").alias("max_attempts"), (F.col("seq") * 1500).alias("initial_interval_us"), F.lit(1.5).alias("backoff_coefficient"),
            F.lit(0).cast("bigint").alias("max_interval_us"), F.when(F.col("seq") == 4, False).alias("jitter"),
            F.when(F.col("seq") == 6, F.array(F.lit("invalid_"))).alias("non_retryable_errors"))).alias("retry"),
        F.when(F.col("seq") % 5 == 0, F.struct(
            F.when(F.col("seq") == 5, F.array(F.lit("k"))).alias("key"), (F.col("seq") * 1_000_000).alias("period_us"),
            F.when(F.col("seq") == 5, "replace").alias("on_conflict"))).alias("unique"),
        F.when(F.col("seq") == 7, F.array(F.lit("a"), F.lit("b"))).when(F.col("seq") == 8, F.array().cast("array<string>")).alias("tags"))


OPTION_REQUESTS_SQL = """
, optreq AS (
  SELECT request_id, seq, CASE WHEN seq = 3 THEN NULL ELSE queue END AS queue, CAST(seq AS INT) - 5 AS priority,
         CAST(floor((delay_ms / 1000 - 150) * 12345) AS BIGINT) AS timeout_us,
         CASE WHEN seq < 5 THEN delay_ms * 1000 + seq END AS visibility_timeout_us
  FROM requests)
, res AS (
  SELECT request_id, seq, queue AS given,
         coalesce(nullif(queue, ''), 'default') AS queue, coalesce(priority, 0) AS priority,
         coalesce(CASE WHEN timeout_us >= 0 THEN floor(timeout_us / 1000) ELSE ceil(timeout_us / 1000) END, 0)::BIGINT AS timeout_ms,
         coalesce(CASE WHEN visibility_timeout_us >= 0 THEN floor(visibility_timeout_us / 1000) ELSE ceil(visibility_timeout_us / 1000) END, 0)::BIGINT AS visibility_timeout_ms
  FROM optreq)
SELECT request_id, queue, priority, timeout_ms, visibility_timeout_ms,
       '{' || concat_ws(',',
          CASE WHEN given IS NULL THEN '"queue":"default"' WHEN given <> '' THEN '"queue":"' || given || '"' END,
          CASE WHEN priority <> 0 THEN '"priority":' || priority END,
          CASE WHEN timeout_ms <> 0 THEN '"timeout_ms":' || timeout_ms END,
          CASE WHEN seq % 3 = 0 THEN '"delay_until":"' || strftime(make_timestamp((1700000000 + request_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') || '"' END,
          CASE WHEN seq % 4 = 0 THEN '"expires_at":"' || strftime(make_timestamp((1700000000 + request_id) * 1000000), '%Y-%m-%dT%H:%M:%S') || '.5Z"' END,
          CASE WHEN seq % 2 = 0 THEN '"retry":{' || concat_ws(',', CASE WHEN seq <> 0 THEN '"max_attempts":' || seq || ',"initial_interval_ms":' || CAST(floor(seq * 1.5) AS INT) END,
               '"backoff_coefficient":1.5', CASE WHEN seq = 4 THEN '"jitter":false' END, CASE WHEN seq = 6 THEN '"non_retryable_errors":["invalid_"]' END) || '}' END,
          CASE WHEN seq % 5 = 0 THEN '"unique":{' || CASE WHEN seq = 5 THEN '"key":["k"],"period_ms":5000,"on_conflict":"replace"' ELSE '' END || '}' END,
          CASE WHEN seq = 7 THEN '"tags":["a","b"]' END,
          CASE WHEN visibility_timeout_ms <> 0 THEN '"visibility_timeout_ms":' || visibility_timeout_ms END) || '}' AS wire_options
FROM res"""


@register("resolve_options", views=("requests",), sql=OPTION_REQUESTS_SQL)
def q_resolve_options(spark, sf):
    return P.resolve_options(_option_requests(spark, sf)).select(
        "request_id", "queue", "priority", "timeout_ms", "visibility_timeout_ms", "wire_options")


@register("resolve_run_at", views=("requests",), sql="""
, src AS (
  SELECT request_id, created_at, delay_ms,
         CASE WHEN seq % 3 <> 2 THEN CAST(CAST(created_at AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY END AS scheduled_at,
         CASE WHEN seq % 2 = 0 THEN 1 END AS delay_pos,
         CASE WHEN seq % 3 = 0 THEN 2 WHEN seq % 3 = 1 THEN 0 END AS scheduled_pos
  FROM requests)
SELECT request_id,
       CASE WHEN delay_pos IS NOT NULL AND delay_ms IS NOT NULL AND scheduled_pos IS NOT NULL AND scheduled_at IS NOT NULL
            THEN CASE WHEN delay_pos > scheduled_pos THEN created_at + delay_ms * INTERVAL 1 MILLISECOND ELSE scheduled_at END
            WHEN delay_pos IS NOT NULL AND delay_ms IS NOT NULL THEN created_at + delay_ms * INTERVAL 1 MILLISECOND
            WHEN scheduled_pos IS NOT NULL AND scheduled_at IS NOT NULL THEN scheduled_at END AS run_at
FROM src""")
def q_resolve_run_at(spark, sf):
    r = fx.requests(spark, sf)
    seq = F.col("seq")
    src = r.select(
        "request_id", "created_at", "delay_ms",
        F.when(seq % 3 != 2, F.to_date("created_at").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
         .alias("scheduled_at"),
        F.when(seq % 2 == 0, F.lit(1)).alias("delay_pos"),
        F.when(seq % 3 == 0, F.lit(2)).when(seq % 3 == 1, F.lit(0)).alias("scheduled_pos"))
    return P.resolve_run_at(src).select("request_id", "run_at")


@register("merge_meta", views=("meta_patches",), sql="""
SELECT job_id, meta_key, arg_max(meta_value, seq) AS meta_value FROM meta_patches GROUP BY job_id, meta_key""")
def q_merge_meta(spark, sf):
    return P.merge_meta(fx.meta_patches(spark, sf))


@register("merge_meta_maps", views=("meta_patches",), sql="""
SELECT job_id, meta_key, arg_max(meta_value, seq) AS meta_value FROM meta_patches GROUP BY job_id, meta_key""")
def q_merge_meta_maps(spark, sf):
    """P6 map form: each patch row carries a MAP; the merged MAP per job is
    read back entry by entry."""
    p = fx.meta_patches(spark, sf).select("job_id", "seq", F.create_map("meta_key", "meta_value").alias("meta"))
    merged = P.merge_meta_maps(p)
    return merged.select("job_id", F.explode("meta").alias("meta_key", "meta_value"))


@register("append_tags", sql="""
WITH src AS (
  SELECT user_id AS job_id, event_id AS seq,
         CASE WHEN value < 10 THEN [event_type] ELSE [event_type, 'v' || CAST(CAST(floor(value / 100) AS INT) AS VARCHAR)] END AS tags
  FROM events),
b AS (
  SELECT job_id, tags,
         coalesce(sum(len(tags)) OVER (PARTITION BY job_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM src)
SELECT job_id, CAST(base + i AS BIGINT) AS pos, tag FROM (
  SELECT job_id, base, unnest(tags) AS tag, unnest(range(len(tags))) AS i FROM b)""")
def q_append_tags(spark, sf):
    e = table(spark, sf, "events")
    tags = F.when(F.col("value") < 10, F.array("event_type")).otherwise(F.array(
        F.col("event_type"), F.concat(F.lit("v"), F.floor(F.col("value") / 100).cast("int").cast("string"))))
    src = e.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), tags.alias("tags"))
    return P.append_tags(src)


@register("expire_jobs", views=("jobs",), sql=f"""
SELECT job_id,
       coalesce(created_at + priority * 200 * INTERVAL 1 DAY < TIMESTAMP '{ORDERS_AS_OF}'
                AND state NOT IN ('completed', 'cancelled', 'discarded'), false) AS expired,
       CASE WHEN coalesce(created_at + priority * 200 * INTERVAL 1 DAY < TIMESTAMP '{ORDERS_AS_OF}'
                AND state NOT IN ('completed', 'cancelled', 'discarded'), false) THEN 'discarded' ELSE state END AS state
FROM jobs""")
def q_expire_jobs(spark, sf):
    j = fx.jobs(spark, sf).withColumn(
        "expires_at", F.col("created_at") + F.make_dt_interval(days=F.col("priority") * 200))
    return P.expire_jobs(j, ORDERS_AS_OF).select("job_id", "expired", "state")


def _args_shapes(spark, sf):
    """Wire args of every shape the decoder handles, from the events table."""
    e = table(spark, sf, "events")
    et = F.col("event_type")
    args = (F.when(et == "signup", F.concat(F.lit("["), F.col("props"), F.lit("]")))
             .when(et == "view", F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("value").cast("string"), F.lit("]")))
             .when(et == "click", F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(',"'), et, F.lit('"]')))
             .when(et == "purchase", F.lit("[]"))
             .otherwise(F.col("props")))
    return e.select(F.col("event_id").alias("request_id"), args.alias("args"))


ARGS_SHAPES_SQL = """
src AS (
  SELECT event_id AS request_id,
         CASE event_type WHEN 'signup' THEN '[' || props || ']'
                         WHEN 'view' THEN '[' || props || ',' || CAST(value AS VARCHAR) || ']'
                         WHEN 'click' THEN '[' || CAST(user_id AS VARCHAR) || ',"' || event_type || '"]'
                         WHEN 'purchase' THEN '[]' ELSE props END AS args
  FROM events),
typed AS (
  SELECT request_id, args, json_type(args) AS t, json_type(args, '$[0]') AS t0,
         CASE WHEN json_type(args) = 'ARRAY' THEN json_array_length(args) END AS n
  FROM src)"""


@register("decode_args", sql=f"""
WITH {ARGS_SHAPES_SQL},
obj AS (SELECT request_id, unnest(json_keys(json_extract(args, '$[0]'))) AS arg_key, json_extract(args, '$[0]') AS o
        FROM typed WHERE t = 'ARRAY' AND t0 = 'OBJECT'),
pos AS (SELECT request_id, args, unnest(range(CAST(n AS BIGINT))) AS i FROM typed WHERE t = 'ARRAY' AND n > 0 AND t0 <> 'OBJECT')
SELECT request_id, 'map' AS args_kind, arg_key, CAST(json_extract(o, '$."' || arg_key || '"') AS VARCHAR) AS arg_value FROM obj
UNION ALL SELECT request_id, 'map', CAST(i AS VARCHAR), CAST(json_extract(args, '$[' || i || ']') AS VARCHAR) FROM pos
UNION ALL SELECT request_id, 'empty', NULL, NULL FROM typed WHERE t = 'ARRAY' AND n = 0
UNION ALL SELECT request_id, 'none', NULL, NULL FROM typed WHERE t <> 'ARRAY'""")
def q_decode_args(spark, sf):
    d = P.decode_args(_args_shapes(spark, sf))
    kind = (F.when(F.col("args_map").isNull(), "none").when(F.cardinality("args_map") == 0, "empty")
             .otherwise("map"))
    return d.select("request_id", kind.alias("args_kind"),
                    F.explode_outer("args_map").alias("arg_key", "v")).select(
        "request_id", "args_kind", "arg_key", A.variant_text(F.col("v")).alias("arg_value"))


@register("encode_args", sql=f"""
WITH {ARGS_SHAPES_SQL},
pos AS (SELECT request_id, args, unnest(range(CAST(n AS BIGINT))) AS i FROM typed WHERE t = 'ARRAY' AND n > 0 AND t0 <> 'OBJECT')
SELECT request_id, '[' || CAST(json(json_extract(args, '$[0]')) AS VARCHAR) || ']' AS args_wire
FROM typed WHERE t = 'ARRAY' AND t0 = 'OBJECT' AND json_extract(args, '$[0]') <> '{{}}'::JSON
UNION ALL SELECT request_id, '[]' FROM typed WHERE t <> 'ARRAY' OR n = 0 OR (t0 = 'OBJECT' AND json_extract(args, '$[0]') = '{{}}'::JSON)
UNION ALL SELECT request_id, '[{{' || string_agg('"' || CAST(i AS VARCHAR) || '":' || CAST(json_extract(args, '$[' || i || ']') AS VARCHAR), ','
                                        ORDER BY CAST(i AS VARCHAR)) || '}}]'
FROM pos GROUP BY request_id""")
def q_encode_args(spark, sf):
    d = P.decode_args(_args_shapes(spark, sf))
    return P.encode_args(d).select("request_id", "args_wire")


@register("typed_args", sql="""
WITH src AS (
  SELECT event_id AS request_id,
         CASE event_type WHEN 'signup' THEN '[' || props || ']'
                         WHEN 'click' THEN '[{"k":"' || CAST(user_id AS VARCHAR) || '"}]'
                         WHEN 'purchase' THEN '[{"k":' || CAST(value AS VARCHAR) || ',"name":"p"}]'
                         WHEN 'view' THEN '[{"k":null,"name":"v"}]'
                         ELSE '[]' END AS args
  FROM events),
f AS (
  SELECT request_id, json_type(args, '$[0].k') AS tk, json_type(args, '$[0].name') AS tn,
         json_extract(args, '$[0].k') AS k, json_extract_string(args, '$[0].name') AS name FROM src),
c AS (
  SELECT *, CASE WHEN tk IS NOT NULL AND tk <> 'NULL'
                  AND NOT (tk IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND CAST(k AS DOUBLE) = floor(CAST(k AS DOUBLE)))
                 THEN 'unmarshal args for evt.test: field k: wrong JSON type for bigint'
                 WHEN tn IS NOT NULL AND tn <> 'NULL' AND tn <> 'VARCHAR'
                 THEN 'unmarshal args for evt.test: field name: wrong JSON type for string' END AS args_error
  FROM f)
SELECT request_id, args_error,
       CASE WHEN args_error IS NULL THEN coalesce(CAST(CAST(k AS DOUBLE) AS BIGINT), 0) END AS k,
       CASE WHEN args_error IS NULL THEN coalesce(name, '') END AS name,
       CASE WHEN args_error IS NOT NULL THEN false END AS args_retryable
FROM c""")
def q_typed_args(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    args = (F.when(et == "signup", F.concat(F.lit("["), F.col("props"), F.lit("]")))
             .when(et == "click", F.concat(F.lit('[{"k":"'), F.col("user_id").cast("string"), F.lit('"}]')))
             .when(et == "purchase", F.concat(F.lit('[{"k":'), F.col("value").cast("string"), F.lit(',"name":"p"}]')))
             .when(et == "view", F.lit('[{"k":null,"name":"v"}]'))
             .otherwise(F.lit("[]")))
    src = P.decode_args(e.select(F.col("event_id").alias("request_id"), args.alias("args")))
    t = P.typed_args(src, "evt.test", [("k", "bigint"), ("name", "string")])
    return t.select("request_id", "args_error", F.col("args_typed.k").alias("k"),
                    F.col("args_typed.name").alias("name"), "args_retryable")


@register("match_jobs", views=("requests",), sql="""
SELECT request_id FROM requests
WHERE type = 'evt.click' AND CAST(json(json_extract(args, '$[0]')) AS VARCHAR) = '{"k":42}'
  AND CAST(json_extract(substr(args, 2, length(args) - 2), '$.k') AS VARCHAR) = '42'
  AND json_extract(substr(args, 2, length(args) - 2), '$.missing') IS NULL""")
def q_match_jobs(spark, sf):
    r = P.decode_args(fx.requests(spark, sf)).withColumn("meta", F.expr("substr(args, 2, length(args) - 2)"))
    return P.match_jobs(r, "evt.click", args={"k": 42}, meta={"k": 42, "missing": None}).select("request_id")


@register("classify_errors", views=("api_responses",), sql="""
SELECT event_id, status, code,
       CASE code WHEN 'not_found' THEN 'not_found' WHEN 'duplicate' THEN 'duplicate' WHEN 'queue_paused' THEN 'queue_paused'
                 WHEN 'rate_limited' THEN 'rate_limited' WHEN 'backend_error' THEN 'backend' WHEN 'timeout' THEN 'timeout'
                 ELSE CASE WHEN status = 409 THEN 'conflict' END END AS error_class
FROM api_responses""")
def q_classify_errors(spark, sf):
    return P.classify_errors(fx.api_responses(spark, sf)).select("event_id", "status", "code", "error_class")


def _error_kinds(spark, sf):
    r = fx.api_responses(spark, sf)
    kind = (F.when(F.col("status") == 200, F.lit(None)).when(F.col("status") == 500, "marked")
             .when(F.col("status") == 404, "other").otherwise("api"))
    return r.select("event_id", kind.alias("error_kind"), "retryable")


ERROR_KIND_SQL = """, k AS (
  SELECT event_id, retryable,
         CASE WHEN status = 200 THEN NULL WHEN status = 500 THEN 'marked' WHEN status = 404 THEN 'other' ELSE 'api' END AS error_kind
  FROM api_responses)"""


@register("api_retryable", views=("api_responses",), sql=ERROR_KIND_SQL + """
SELECT event_id, error_kind,
       CASE WHEN error_kind IS NULL THEN NULL WHEN error_kind = 'marked' THEN false
            WHEN error_kind = 'api' THEN coalesce(retryable, false) ELSE false END AS is_retryable
FROM k""")
def q_api_retryable(spark, sf):
    return P.api_retryable(_error_kinds(spark, sf)).select("event_id", "error_kind", "is_retryable")


@register("handler_retryable", views=("api_responses",), sql=ERROR_KIND_SQL + """
SELECT event_id, error_kind,
       CASE WHEN error_kind IS NULL THEN NULL WHEN error_kind = 'marked' THEN false ELSE true END AS is_retryable
FROM k""")
def q_handler_retryable(spark, sf):
    return P.handler_retryable(_error_kinds(spark, sf)).select("event_id", "error_kind", "is_retryable")


@register("ensure_trace_id", views=("jobs",), sql="""
SELECT job_id,
       CASE WHEN priority >= 4 THEN 'tr-' || CAST(job_id AS VARCHAR) ELSE md5(CAST(job_id AS VARCHAR)) END AS trace_id,
       CASE WHEN priority >= 4 THEN 1 ELSE 2 END AS n_meta
FROM jobs""")
def q_ensure_trace_id(spark, sf):
    j = fx.jobs(spark, sf)
    meta = F.when(F.col("priority") >= 4, F.create_map(F.lit("trace_id"), F.concat(F.lit("tr-"), F.col("job_id").cast("string")))) \
        .otherwise(F.create_map(F.lit("source"), F.lit("ledger")))
    out = P.ensure_trace_id(j.select("job_id", meta.alias("meta")))
    return out.select("job_id", F.col("meta")["trace_id"].alias("trace_id"), F.cardinality("meta").alias("n_meta"))


def _typed_attempts(spark, sf):
    a = fx.attempts(spark, sf)
    j = fx.jobs(spark, sf).select("job_id", "type", "queue")
    return a.join(j, "job_id")


@register("to_spans", views=("attempts", "jobs"), sql="""
SELECT a.job_id, a.attempt, 'job ' || j.type AS span_name, 'consumer' AS span_kind,
       j.type AS attr_job_type, CAST(a.job_id AS VARCHAR) AS attr_job_id, j.queue AS attr_job_queue,
       a.attempt AS attr_job_attempt,
       CASE WHEN a.outcome = 'completed' THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN a.outcome = 'completed' THEN '' ELSE coalesce(a.error_code, 'handler_error') END AS status_message,
       a.started_at AS start_time, a.started_at + a.duration_ms * INTERVAL 1 MILLISECOND AS end_time
FROM attempts a JOIN jobs j ON a.job_id = j.job_id""")
def q_to_spans(spark, sf):
    return P.to_spans(_typed_attempts(spark, sf))


@register("to_execution_log", views=("attempts", "jobs"), sql="""
, t AS (SELECT a.*, j.type, j.queue FROM attempts a JOIN jobs j ON a.job_id = j.job_id)
SELECT type AS job_type, CAST(job_id AS VARCHAR) AS log_job_id, queue AS job_queue, attempt AS job_attempt,
       0 AS line, 'DEBUG' AS level, 'job started' AS msg, started_at AS time,
       CAST(NULL AS DOUBLE) AS duration_ms, CAST(NULL AS VARCHAR) AS error
FROM t
UNION ALL
SELECT type, CAST(job_id AS VARCHAR), queue, attempt, 1,
       CASE WHEN outcome = 'completed' THEN 'INFO' ELSE 'ERROR' END,
       CASE WHEN outcome = 'completed' THEN 'job completed' ELSE 'job failed' END,
       started_at + duration_ms * INTERVAL 1 MILLISECOND,
       floor(duration_ms * 1000) / 1000.0,
       CASE WHEN outcome <> 'completed' THEN coalesce(error_code, 'handler_error') END
FROM t""")
def q_to_execution_log(spark, sf):
    return P.to_execution_log(_typed_attempts(spark, sf))
