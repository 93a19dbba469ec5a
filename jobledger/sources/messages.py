"""Queue-message batches and push deliveries.

Each record body is parsed once and checked field by field against the job
event's wire types, like ``sources.jobs``; a body that does not decode is kept
as a failed item instead of failing the task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger import schemas as S
from jobledger.functions import decode as D
from jobledger.operators.process import process


def _job_event() -> T.StructType:
    return T._parse_datatype_string(S.JOB_EVENT)


def read_messages(df: DataFrame, records: str | None = None) -> DataFrame:
    """Message batch rows -> one row per message with the decoded job.

    ``df`` has either a ``Records`` array (``records`` names it) per batch,
    or flat ``batch_id, message_id, body`` rows. Output: ``batch_id,
    message_id, job (struct), decode_error``.
    """
    if records:
        df = df.select("batch_id", F.explode(records).alias("r")).select(
            "batch_id", F.col("r.messageId").alias("message_id"), F.col("r.body").alias("body"))
    schema = _job_event()
    out = D.decode(df.select("batch_id", "message_id", "body"), F.col("body"), schema)
    ok = D.decoded(schema)
    return out.select("batch_id", "message_id", F.when(ok, F.expr(D.record(schema))).alias("job"),
                      F.when(~ok, F.lit("failed to unmarshal message")).alias("decode_error"))


def message_outcomes(messages: DataFrame, handler_types: DataFrame) -> DataFrame:
    """Mark each decoded message failed when its body did not decode or no
    handler is registered for its type (the message is redelivered).

    ``handler_types`` is the registry (one row per type); AQE broadcasts it
    where its measured size allows."""
    reg = handler_types.select(F.col("type").alias("_htype")).distinct()
    j = messages.join(reg, messages["job.type"] == reg["_htype"], "left")
    failed = F.col("decode_error").isNotNull() | F.col("_htype").isNull()
    return j.select("batch_id", "message_id", "job", "decode_error", failed.alias("failed"))


def read_push_deliveries(df: DataFrame, body: str = "body") -> DataFrame:
    """Push delivery bodies -> request fields; an undecodable body is a
    final failure ``invalid_request`` (not retryable)."""
    schema = T._parse_datatype_string(S.PUSH_DELIVERY)
    out = D.decode(df, F.col(body), schema)
    ok = D.decoded(schema)
    bad = ~ok
    return out.select(
        *[c for c in df.columns],
        F.when(ok, F.expr(D.record(_job_event(), "job"))).alias("job"),
        F.when(ok, F.col("_x.worker_id")).alias("worker_id"),
        F.when(ok, F.col("_x.delivery_id")).alias("delivery_id"),
        F.when(bad, F.lit("failed")).alias("status"),
        F.when(bad, F.lit("invalid_request")).alias("error_code"),
        F.when(bad, F.lit("failed to decode request body")).alias("error_message"),
        F.when(bad, F.lit(False)).alias("error_retryable"),
    )


def _events(messages: DataFrame, *keep: str) -> DataFrame:
    """Messages as rows that handlers take: the decoded job's fields, and the
    columns of ``keep``, which travel along."""
    return messages.select(*keep, F.coalesce("job.id", F.lit("")).alias("job_id"), F.coalesce("job.type", F.lit("")).alias("type"),
                           F.col("job.queue").alias("queue"), F.col("job.attempt").alias("attempt"), F.col("job.args").alias("args"), F.col("job.meta").alias("meta"))


def handle_messages(messages: DataFrame, handlers: dict[str, Callable]) -> DataFrame:
    """Run the handler of each decoded message (S3 to X1). One row per
    message: batch_id, message_id, failed, error_message. A message fails, and
    is redelivered, if its body does not decode, no handler is registered for
    its type, or its handler fails. Rows pass the handlers in one go, without
    a shuffle; repeated rows of a message run each and have their own outcome."""
    rows = _events(messages, "batch_id", "message_id", "decode_error")
    ran = process(rows, handlers, on_missing="fail_item", carry=("batch_id", "message_id", "decode_error"), skip="decode_error")
    return ran.select("batch_id", "message_id", (F.col("state").isNull() | (F.col("state") != "completed")).alias("failed"),
                      F.coalesce("decode_error", "error_message").alias("error_message"))


def handle_deliveries(deliveries: DataFrame, handlers: dict[str, Callable], key: str = "delivery_id") -> DataFrame:
    """Run the handler of each decoded push delivery (S4 to X1): the
    delivery's key, status, error_code, error_message, error_retryable, one row
    a delivery, also of repeated ones. Every failure of a handler is
    retryable, a missing handler's too; only an undecodable body is final."""
    bad = F.struct("status", "error_code", "error_message", "error_retryable")
    rows = _events(deliveries.select(F.col(key).alias("_of"), "job", F.when(F.col("status").isNotNull(), bad).alias("_bad")), "_of", "_bad")
    ran = process(rows, handlers, on_missing="retry", carry=("_of", "_bad"), skip="_bad")
    missing = F.concat(F.lit("no handler registered for job type: "), "type")
    text = F.when(F.col("type").isin(*handlers), F.col("error_message")).otherwise(missing)
    failed = F.col("state") == "failed"
    return ran.select(F.col("_of").alias(key), F.coalesce("_bad.status", "state").alias("status"),
                      F.coalesce("_bad.error_code", "error_code").alias("error_code"),
                      F.coalesce("_bad.error_message", F.when(failed, text)).alias("error_message"),
                      F.coalesce("_bad.error_retryable", F.when(failed, F.lit(True))).alias("error_retryable"))
