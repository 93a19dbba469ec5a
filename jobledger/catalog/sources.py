"""Queries for sources and sinks (S1-S6) and batch failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobledger.catalog.registry import register
from jobledger.operators import aggregations as agg
from jobledger.operators import process as X
from jobledger.sources import events as EV
from jobledger.sources import fixtures as fx
from jobledger.sources import jobs as J
from jobledger.sources import messages as M
from jobledger.sources import responses as R
from jobledger.catalog.aggregates import _responses_with_headers
from jobledger.plans.strategy import literal_frame

def _envelopes(spark, sf):
    """Ledger jobs with all envelope fields, some of them empty."""
    j = fx.jobs(spark, sf)
    k = F.col("job_id")
    return j.select(
        k.cast("string").alias("id"), F.when(k % 11 != 0, F.col("type")).alias("type"), F.when(k % 13 != 0, F.col("state")).alias("state"), "queue",
        "priority", "attempt", F.when(k % 4 != 0, F.col("max_attempts")).alias("max_attempts"), (k % 5 * 1000).cast("bigint").alias("timeout_ms"),
        F.when(k % 3 == 0, F.array(F.lit("a"), F.concat(F.lit("t"), (k % 4).cast("string")))).when(k % 3 == 1, F.array().cast("array<string>")).alias("tags"),
        F.when(k % 4 == 0, F.lit("{}")).when(k % 4 == 1, F.concat(F.lit('{"k":'), k.cast("string"), F.lit(',"b":{"x":[1,null]}}'))).alias("meta"),
        F.when(k % 6 == 0, F.concat(F.lit('{"n":'), F.col("attempt").cast("string"), F.lit("}"))).when(k % 6 == 1, F.lit("[1]")).alias("result"),
        F.when(k % 5 == 0, F.struct(F.lit("timeout").alias("code"), F.lit("late").alias("message"), (k % 2 == 0).alias("retryable"),
                                    F.when(k % 10 == 0, F.concat(F.lit('{"ms":'), k.cast("string"), F.lit("}"))).alias("details"))).alias("error"),
        "created_at", F.col("created_at").alias("enqueued_at"), "started_at",
        *[F.when(k % m == 0, F.col("created_at") + F.make_dt_interval(secs=F.lit(m))).alias(n)
          for n, m in (("completed_at", 2), ("cancelled_at", 3), ("discarded_at", 5), ("scheduled_at", 7), ("expires_at", 11))],
        F.when(k % 2 == 0, F.concat(F.lit('[{"z":1,"id":'), k.cast("string"), F.lit("}]"))).when(k % 7 == 0, F.lit("[1,\"x\"]")).alias("args"),
        F.when(k % 9 == 0, F.lit("active")).otherwise("").alias("previous_state"))


MESSAGE_HANDLERS = ["evt.signup", "evt.view", "evt.click", "evt.purchase"]


@register("read_jobs", views=("jobs",), sql="""
SELECT CAST(job_id AS VARCHAR) AS id, type, state, queue, priority, attempt, max_attempts, created_at, started_at
FROM jobs""")
def q_read_jobs(spark, sf):
    """Round trip: ledger rows -> wire envelopes (S2) -> decoded rows."""
    jobs = fx.jobs(spark, sf).withColumnRenamed("job_id", "id")
    ok, _bad = J.parse_jobs(J.encode_jobs(jobs))
    return ok.select("id", "type", "state", "queue", "priority", "attempt", "max_attempts",
                     F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                     F.col("started_at").cast("timestamp_ntz").alias("started_at"))


@register("read_envelopes", views=("jobs",), sql="""
SELECT CAST(job_id AS VARCHAR) AS id, CASE WHEN job_id % 11 <> 0 THEN type ELSE '' END AS type, CASE WHEN job_id % 13 <> 0 THEN state ELSE '' END AS state,
       queue, priority, attempt, CASE WHEN job_id % 4 <> 0 THEN max_attempts ELSE 0 END AS max_attempts,
       nullif(job_id % 5 * 1000, 0) AS timeout_ms,
       CASE WHEN job_id % 3 = 0 THEN 'a,t' || CAST(job_id % 4 AS VARCHAR) END AS tags,
       CASE WHEN job_id % 4 = 1 THEN '{"b":{"x":[1,null]},"k":' || CAST(job_id AS VARCHAR) || '}' END AS meta,
       CASE WHEN job_id % 6 = 0 THEN '{"n":' || CAST(attempt AS VARCHAR) || '}' END AS result,
       CASE WHEN job_id % 5 = 0 THEN 'timeout' END AS error_code, CASE WHEN job_id % 5 = 0 THEN 'late' END AS error_message,
       CASE WHEN job_id % 5 = 0 THEN job_id % 2 = 0 END AS error_retryable,
       CASE WHEN job_id % 10 = 0 THEN '{"ms":' || CAST(job_id AS VARCHAR) || '}' END AS error_details,
       CAST(created_at AS TIMESTAMP) AS created_at, CAST(created_at AS TIMESTAMP) AS enqueued_at, CAST(started_at AS TIMESTAMP) AS started_at,
       CASE WHEN job_id % 2 = 0 THEN created_at + INTERVAL 2 SECOND END AS completed_at, CASE WHEN job_id % 3 = 0 THEN created_at + INTERVAL 3 SECOND END AS cancelled_at,
       CASE WHEN job_id % 5 = 0 THEN created_at + INTERVAL 5 SECOND END AS discarded_at, CASE WHEN job_id % 7 = 0 THEN created_at + INTERVAL 7 SECOND END AS scheduled_at,
       CASE WHEN job_id % 11 = 0 THEN created_at + INTERVAL 11 SECOND END AS expires_at,
       CASE WHEN job_id % 2 = 0 THEN '[{"id":' || CAST(job_id AS VARCHAR) || ',"z":1}]' WHEN job_id % 7 = 0 THEN '[1,"x"]' ELSE '[]' END AS args,
       CASE WHEN job_id % 9 = 0 THEN 'active' END AS previous_state
FROM jobs""")
def q_read_envelopes(spark, sf):
    """Round trip of all envelope fields: rows -> wire (S2) -> rows."""
    ok, _bad = J.parse_jobs(J.encode_jobs(_envelopes(spark, sf)))
    e = F.col("error")
    plain = ["id", "type", "state", "queue", "priority", "attempt", "max_attempts", "timeout_ms", "meta", "result", "args", "previous_state"]
    times = ["created_at", "enqueued_at", "started_at", "completed_at", "cancelled_at", "discarded_at", "scheduled_at", "expires_at"]
    return ok.select(*plain, F.array_join("tags", ",").alias("tags"), *[e[n].alias(f"error_{n}") for n in ("code", "message", "retryable", "details")],
                     *[F.col(t).cast("timestamp_ntz").alias(t) for t in times])


@register("corrupt_envelopes", views=("requests",), sql="""
SELECT request_id % 9 AS kind, count(*) AS n FROM requests WHERE request_id % 9 NOT IN (0, 1, 2) GROUP BY request_id % 9""")
def q_corrupt_envelopes(spark, sf):
    """Lines that are no envelope, told by what is wrong with them."""
    k = F.col("request_id") % 9
    line = (F.when(k == 0, '{"id":"a","other":5}').when(k == 1, "null").when(k == 2, '{"id":null,"tags":[null,"x"],"args":5}')
             .when(k == 3, "").when(k == 4, "[1]").when(k == 5, '{"id":5}').when(k == 6, '{"attempt":1.5}').when(k == 7, '{"created_at":"yesterday"}')
             .otherwise('{"error":{"code":"x","details":"text"}}'))
    _ok, bad = J.parse_jobs(fx.requests(spark, sf).select(line.alias("value")))
    v = F.col(J.CORRUPT)
    kind = (F.when(v == "", 3).when(v.startswith("["), 4).when(v.contains("id"), 5).when(v.contains("attempt"), 6).when(v.contains("created"), 7)
             .when(v.contains("error"), 8).otherwise(0))
    return bad.groupBy(kind.cast("bigint").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("read_messages", views=("messages",), sql="""
SELECT batch_id, message_id,
       CASE WHEN body <> '{bad' THEN json_extract_string(body, '$.id') END AS job_id,
       CASE WHEN body <> '{bad' THEN json_extract_string(body, '$.type') END AS job_type,
       body = '{bad' AS decode_failed
FROM messages""")
def q_read_messages(spark, sf):
    m = M.read_messages(fx.messages(spark, sf))
    return m.select("batch_id", "message_id", F.col("job.id").alias("job_id"), F.col("job.type").alias("job_type"),
                    F.col("decode_error").isNotNull().alias("decode_failed"))


@register("batch_failures", views=("messages",), sql=f"""
, f AS (SELECT batch_id, message_id FROM messages
        WHERE body = '{{bad' OR json_extract_string(body, '$.type') NOT IN ({", ".join(repr(t) for t in MESSAGE_HANDLERS)}))
SELECT batch_id, string_agg(message_id, ',' ORDER BY message_id) AS failed_ids, count(*) AS n_failed
FROM f GROUP BY batch_id""")
def q_batch_failures(spark, sf):
    reg = literal_frame(spark, [(t,) for t in MESSAGE_HANDLERS], "type string")
    items = M.message_outcomes(M.read_messages(fx.messages(spark, sf)), reg)
    out = agg.batch_failures(items)
    return out.select("batch_id", F.array_join("failed_ids", ",").alias("failed_ids"), "n_failed")


@register("read_push_deliveries", views=("messages",), sql="""
SELECT message_id,
       CASE WHEN body <> '{bad' THEN json_extract_string(body, '$.id') END AS job_id,
       CASE WHEN body <> '{bad' THEN 'w-' || CAST(batch_id AS VARCHAR) END AS worker_id,
       CASE WHEN body = '{bad' THEN 'failed' END AS status,
       CASE WHEN body = '{bad' THEN 'invalid_request' END AS error_code,
       CASE WHEN body = '{bad' THEN false END AS error_retryable
FROM messages""")
def q_read_push_deliveries(spark, sf):
    m = fx.messages(spark, sf)
    body = F.concat(F.lit('{"job":'), F.col("body"), F.lit(',"worker_id":"w-'), F.col("batch_id").cast("string"),
                    F.lit('","delivery_id":"'), F.col("message_id"), F.lit('"}'))
    d = M.read_push_deliveries(m.select("message_id", body.alias("body")))
    return d.select("message_id", F.col("job.id").alias("job_id"), "worker_id", "status", "error_code",
                    "error_retryable")


@register("read_events", views=("job_events",), sql="""
SELECT type, 'ledger' AS source, subject, time, CAST(json(data) AS VARCHAR) AS data FROM job_events""")
def q_read_events(spark, sf):
    """Round trip: event rows -> JSON envelopes -> decoded events."""
    ev = fx.job_events(spark, sf).withColumn("source", F.lit("ledger"))
    back = EV.parse_events(EV.encode_events(ev))
    return back.select("type", "source", "subject", F.col("time").cast("timestamp_ntz").alias("time"), "data")


@register("parse_error_responses", views=("api_responses",), sql="""
, b AS (SELECT event_id, status, value,
          CASE status WHEN 429 THEN '{"error":{"code":"rate_limited","message":"slow down","retryable":true,"request_id":"req-' || CAST(event_id AS VARCHAR) || '"}}'
                      WHEN 404 THEN '{"error":{"code":"not_found","message":"no job ' || CAST(event_id AS VARCHAR) || '","retryable":false}}'
                      WHEN 409 THEN 'conflict!'
                      WHEN 500 THEN '{"error":{"code":"backend_error","message":"db down","retryable":true,"details":{"shard":' || CAST(event_id % 7 AS VARCHAR) || '}}}'
          END AS body,
          CASE WHEN status = 429 THEN CAST(round(value / 10, 1) AS VARCHAR) WHEN status = 500 THEN 'Wed, 21 Oct 2015 07:28:00 GMT' ELSE '' END AS ra,
          CASE WHEN status IN (429, 200) THEN CAST(CAST(floor(value) AS BIGINT) % 100 AS VARCHAR) ELSE '' END AS rem,
          CASE WHEN status IN (429, 200) THEN '100' ELSE '' END AS lim,
          CASE WHEN status = 429 THEN CAST(1704067200 + event_id AS VARCHAR) WHEN status = 200 THEN 'soon' ELSE '' END AS rst
        FROM api_responses WHERE status >= 400)
, d AS (SELECT *, status <> 409 AS ok, CASE WHEN status <> 409 THEN body END AS jbody, coalesce(TRY_CAST(ra AS DOUBLE), 0.0) * 1000 AS ra_ms FROM b)
, p AS (SELECT *, lim <> '' OR rem <> '' OR rst <> '' OR ra_ms <> 0 AS present FROM d)
SELECT event_id, status AS http_status,
       CASE WHEN ok THEN coalesce(json_extract_string(jbody, '$.error.code'), '') ELSE 'unknown' END AS code,
       CASE WHEN ok THEN coalesce(json_extract_string(jbody, '$.error.message'), '') ELSE 'HTTP ' || CAST(status AS VARCHAR) || ': ' || body END AS message,
       ok AND coalesce(CAST(json_extract(jbody, '$.error.retryable') AS BOOLEAN), false) AS retryable,
       CASE WHEN ok THEN coalesce(json_extract_string(jbody, '$.error.request_id'), '') END AS request_id,
       CASE WHEN ok THEN ra_ms ELSE 0.0 END AS retry_after_ms,
       CASE WHEN ok AND present THEN coalesce(TRY_CAST(lim AS BIGINT), 0) END AS rl_limit,
       CASE WHEN ok AND present THEN coalesce(TRY_CAST(rem AS BIGINT), 0) END AS rl_remaining,
       CASE WHEN ok AND present THEN coalesce(TRY_CAST(rst AS BIGINT), 0) END AS rl_reset
FROM p""")
def q_parse_error_responses(spark, sf):
    r = _responses_with_headers(spark, sf)
    st, eid = F.col("status"), F.col("event_id").cast("string")
    body = (F.when(st == 429, F.concat(F.lit('{"error":{"code":"rate_limited","message":"slow down","retryable":true,"request_id":"req-'), eid, F.lit('"}}')))
             .when(st == 404, F.concat(F.lit('{"error":{"code":"not_found","message":"no job '), eid, F.lit('","retryable":false}}')))
             .when(st == 409, F.lit("conflict!"))
             .when(st == 500, F.concat(F.lit('{"error":{"code":"backend_error","message":"db down","retryable":true,"details":{"shard":'),
                                       (F.col("event_id") % 7).cast("string"), F.lit("}}}"))))
    out = R.parse_error_responses(r.withColumn("body", body))
    return out.select("event_id", "http_status", "code", "message", "retryable", "request_id",
                      "retry_after_ms", "rl_limit", "rl_remaining", "rl_reset")


@register("write_jobs", views=("jobs",), sql="""
SELECT CAST(job_id AS VARCHAR) AS id,
       '{"id":"' || CAST(job_id AS VARCHAR) || '","type":"' || type || '","state":"' || state || '","queue":"' || queue
       || '","priority":' || CAST(priority AS VARCHAR) || ',"attempt":' || CAST(attempt AS VARCHAR) || ',"max_attempts":3'
       || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') || '"'
       || CASE WHEN started_at IS NOT NULL THEN ',"started_at":"' || strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') || '"' ELSE '' END
       || ',"args":[]}' AS value
FROM jobs""")
def q_write_jobs(spark, sf):
    """Job rows as wire envelopes (the text each output line carries)."""
    jobs = fx.jobs(spark, sf).withColumnRenamed("job_id", "id")
    return J.encode_jobs(jobs.select("id", "type", "state", "queue", "priority", "attempt", "max_attempts",
                                     "created_at", "started_at")).select(
        F.get_json_object("value", "$.id").alias("id"), "value")


@register("handle_messages", views=("messages",), sql=f"""
SELECT batch_id, message_id,
       CASE WHEN body = '{{bad' THEN true ELSE json_extract_string(body, '$.type') NOT IN ({", ".join(repr(t) for t in MESSAGE_HANDLERS)})
         OR CAST(json_extract(body, '$.args[0].k') AS BIGINT) % 2 = 1 END AS failed,
       CASE WHEN body = '{{bad' THEN 'failed to unmarshal message'
            WHEN json_extract_string(body, '$.type') NOT IN ({", ".join(repr(t) for t in MESSAGE_HANDLERS)})
            THEN 'no handler registered for job type "' || json_extract_string(body, '$.type') || '"'
            WHEN CAST(json_extract(body, '$.args[0].k') AS BIGINT) % 2 = 1
            THEN 'odd' END AS error_message
FROM messages""")
def q_handle_messages(spark, sf):
    """Message batches through their handlers; one failing handler fails its
    message only."""
    h = {t: _message_handler for t in MESSAGE_HANDLERS}
    return M.handle_messages(M.read_messages(fx.messages(spark, sf)), h)


def _message_handler(job):
    if job["args"]["k"] % 2:
        raise X.JobError("odd")


@register("handle_deliveries", views=("messages",), sql=f"""
, d AS (SELECT message_id AS delivery_id, body = '{{bad' AS bad, json_extract_string(CASE WHEN body <> '{{bad' THEN body END, '$.type') AS type,
               CAST(json_extract(CASE WHEN body <> '{{bad' THEN body END, '$.args[0].k') AS BIGINT) AS k FROM messages)
, o AS (SELECT delivery_id, CASE WHEN bad THEN 'failed to decode request body'
                 WHEN type NOT IN ({", ".join(repr(t) for t in MESSAGE_HANDLERS)}) THEN 'no handler registered for job type: ' || type
                 WHEN k % 2 = 1 THEN 'odd' END AS error_message, bad FROM d)
SELECT delivery_id, CASE WHEN error_message IS NULL THEN 'completed' ELSE 'failed' END AS status,
       CASE WHEN bad THEN 'invalid_request' WHEN error_message IS NOT NULL THEN 'handler_error' END AS error_code, error_message,
       CASE WHEN error_message IS NOT NULL THEN NOT bad END AS error_retryable
FROM o""")
def q_handle_deliveries(spark, sf):
    """Push deliveries through their handlers; each fails or completes on its
    own, and only an undecodable body is final."""
    m = fx.messages(spark, sf)
    body = F.concat(F.lit('{"job":'), F.col("body"), F.lit("}"))
    d = M.read_push_deliveries(m.select(F.col("message_id").alias("delivery_key"), body.alias("body")))
    d = d.drop("delivery_id").withColumnRenamed("delivery_key", "delivery_id")
    return M.handle_deliveries(d, {t: _message_handler for t in MESSAGE_HANDLERS})


@register("corrupt_events", views=("job_events",), sql="""
, k AS (SELECT event_id % 9 AS kind, count(*) AS n FROM job_events GROUP BY event_id % 9)
SELECT kind, kind IN (0, 1, 2) AS read, n FROM k""")
def q_corrupt_events(spark, sf):
    """Event lines told by what is wrong with them (S5): three kinds read."""
    k = F.col("event_id") % 9
    line = (F.when(k == 0, '{"type":"0","other":5}').when(k == 1, '{"type":"1","subject":null,"data":{}}')
             .when(k == 2, '{"type":"2","time":"2024-01-01T00:00:00.5+02:00"}').when(k == 3, '{"type":"3","subject":5}').when(k == 4, '{"type":"4"')
             .when(k == 5, '["5"]').when(k == 6, '{"type":"6","time":"yesterday"}').when(k == 7, '{"type":"7","data":[1]}').otherwise('{"type":"8","source":true}'))
    good, bad = EV.split_events(fx.job_events(spark, sf).select(line.alias("value")))
    kinds = good.select(F.col("type").cast("bigint").alias("kind"), F.lit(True).alias("read")).unionByName(
        bad.select(F.regexp_extract(EV.CORRUPT, r"\d", 0).cast("bigint").alias("kind"), F.lit(False).alias("read")))
    return kinds.groupBy("kind", "read").agg(F.count(F.lit(1)).alias("n"))
