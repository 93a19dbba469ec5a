"""Projections, filters and scalar expressions over job tables.

All of these are narrow transformations (no shuffle) except where a table
form needs grouping (P6, P7), which aggregates or windows by job key only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.functions import args as A
from jobledger.functions import errors as E
from jobledger.functions import validation as V
from jobledger.functions.maps import merge_last_wins
from jobledger.functions.timecols import plus_ms, ts_lit
from jobledger.functions.wire import nonempty_array, nonempty_string, rfc3339


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- P1 / P2 / P3 -------------------------------------------------------------

def validate_types(df: DataFrame, col: str = "type") -> DataFrame:
    """Add ``type_reason`` (NULL when valid)."""
    return df.withColumn("type_reason", V.type_reason(col))


def validate_queues(df: DataFrame, col: str = "queue") -> DataFrame:
    """Add ``queue_reason`` (NULL when valid; empty means default)."""
    return df.withColumn("queue_reason", V.queue_reason(col))


def is_terminal(col="state") -> Column:
    return _c(col).isin(*K.TERMINAL_STATES)


def mark_terminal(df: DataFrame, col: str = "state") -> DataFrame:
    """P3 as one flag column ``terminal`` (no state: open), for a single scan."""
    return df.withColumn("terminal", F.coalesce(is_terminal(col), F.lit(False)))


def split_terminal(df: DataFrame, col: str = "state") -> tuple[DataFrame, DataFrame]:
    """(open jobs, terminal jobs); both are filters over one lazy plan."""
    marked = mark_terminal(df, col)
    return marked.filter(~F.col("terminal")).drop("terminal"), marked.filter("terminal").drop("terminal")


# --- P4 / P5 ------------------------------------------------------------------

def _trunc_ms(us) -> Column:
    u = _c(us)
    return F.when(u >= 0, F.floor(u / 1000)).otherwise(F.ceil(u / 1000)).cast("bigint")


RETRY_TYPE = ("struct<max_attempts:int,initial_interval_us:bigint,backoff_coefficient:double,max_interval_us:bigint,"
              "jitter:boolean,non_retryable_errors:array<string>>")
UNIQUE_TYPE = "struct<key:array<string>,period_us:bigint,on_conflict:string>"


def _given(df: DataFrame, col, dtype) -> Column:
    return _c(col) if not isinstance(col, str) or col in df.columns else F.lit(None).cast(dtype)


def wire_options(df: DataFrame, queue="queue", priority="priority",
                 timeout_us="timeout_us", visibility_timeout_us="visibility_timeout_us", delay_until="delay_until",
                 expires_at="expires_at", retry="retry", unique="unique", tags="tags") -> Column:
    """Wire form of the nine options (see ``resolve_options``) as JSON text."""
    def some(c, empty):
        return F.when(c != empty, c)

    def ms(c):
        return some(F.coalesce(_trunc_ms(c), F.lit(0)), 0)

    q0 = _given(df, queue, "string")
    r, u = _given(df, retry, RETRY_TYPE), _given(df, unique, UNIQUE_TYPE)
    return F.to_json(F.struct(
        F.when(q0.isNull(), F.lit(K.DEFAULT_QUEUE)).when(q0 != "", q0).alias("queue"),
        some(F.coalesce(_given(df, priority, "int"), F.lit(0)).cast("int"), 0).alias("priority"),
        ms(_given(df, timeout_us, "bigint")).alias("timeout_ms"),
        rfc3339(_given(df, delay_until, "timestamp")).alias("delay_until"),
        rfc3339(_given(df, expires_at, "timestamp")).alias("expires_at"),
        F.when(r.isNotNull(), F.struct(
            some(r["max_attempts"], 0).alias("max_attempts"), ms(r["initial_interval_us"]).alias("initial_interval_ms"),
            some(r["backoff_coefficient"], 0).alias("backoff_coefficient"), ms(r["max_interval_us"]).alias("max_interval_ms"),
            r["jitter"].alias("jitter"), nonempty_array(r["non_retryable_errors"]).alias("non_retryable_errors"))).alias("retry"),
        F.when(u.isNotNull(), F.struct(
            nonempty_array(u["key"]).alias("key"), ms(u["period_us"]).alias("period_ms"),
            nonempty_string(u["on_conflict"]).alias("on_conflict"))).alias("unique"),
        nonempty_array(_given(df, tags, "array<string>")).alias("tags"),
        ms(_given(df, visibility_timeout_us, "bigint")).alias("visibility_timeout_ms"),
    ))


def resolve_options(df: DataFrame, queue="queue", priority="priority",
                    timeout_us="timeout_us", visibility_timeout_us="visibility_timeout_us", delay_until="delay_until",
                    expires_at="expires_at", retry="retry", unique="unique", tags="tags") -> DataFrame:
    """Option defaults and wire form of all nine options.

    queue defaults to ``default`` (an explicit empty queue also resolves to
    the default but is left off the wire, as an omitted empty field), priority to 0, durations (microseconds) become whole
    milliseconds truncated toward zero; zero, empty and absent values are
    omitted on the wire. ``retry`` is a struct (max_attempts,
    initial_interval_us, backoff_coefficient, max_interval_us, jitter,
    non_retryable_errors), ``unique`` one of (key, period_us, on_conflict);
    given, each is written as an object, even an empty one. Columns that
    ``df`` lacks are options not given; other columns stay as they are.
    """
    wire = wire_options(df, queue, priority, timeout_us, visibility_timeout_us, delay_until, expires_at, retry, unique, tags)
    q = F.coalesce(F.nullif(_given(df, queue, "string"), F.lit("")), F.lit(K.DEFAULT_QUEUE))
    p = F.coalesce(_given(df, priority, "int"), F.lit(0)).cast("int")
    t = F.coalesce(_trunc_ms(_given(df, timeout_us, "bigint")), F.lit(0))
    vt = F.coalesce(_trunc_ms(_given(df, visibility_timeout_us, "bigint")), F.lit(0))
    return (df.withColumn("wire_options", wire).withColumn("queue", q).withColumn("priority", p)
              .withColumn("timeout_ms", t).withColumn("visibility_timeout_ms", vt))


def resolve_run_at(df: DataFrame, created="created_at", delay_ms="delay_ms", scheduled_at="scheduled_at",
                   delay_pos="delay_pos", scheduled_pos="scheduled_pos") -> DataFrame:
    """P5: delay and absolute time set the same field; the option given last
    (higher position) wins. Delay is relative to ``created``."""
    by_delay = plus_ms(created, delay_ms)
    d_on = _c(delay_pos).isNotNull() & _c(delay_ms).isNotNull()
    s_on = _c(scheduled_pos).isNotNull() & _c(scheduled_at).isNotNull()
    run_at = (F.when(d_on & s_on, F.when(_c(delay_pos) > _c(scheduled_pos), by_delay).otherwise(_c(scheduled_at)))
               .when(d_on, by_delay).when(s_on, _c(scheduled_at)))
    return df.withColumn("run_at", run_at)


# --- P6 / P7 ------------------------------------------------------------------

def merge_meta(patches: DataFrame, by: str = "job_id", order: str = "seq",
               key: str = "meta_key", value: str = "meta_value") -> DataFrame:
    """P6 (table form): the latest value per (job, key); later patches win.

    One partial aggregate per (job, key): a job with many patches never
    gathers them in one place, only its distinct keys survive the shuffle.
    """
    return patches.groupBy(by, key).agg(F.max_by(value, order).alias(value))


def merge_meta_maps(meta_patches: DataFrame, by: str = "job_id", order: str = "seq",
                    meta: str = "meta") -> DataFrame:
    """P6 (map form): per job, one MAP built from the latest value per key."""
    long = meta_patches.select(by, order, F.explode(meta).alias("meta_key", "meta_value"))
    latest = merge_meta(long, by, order)
    return latest.groupBy(by).agg(
        A.sorted_map(F.map_from_entries(F.collect_list(F.struct("meta_key", "meta_value")))).alias(meta))


def merge_meta_row(base, patch) -> Column:
    """P6 (row form): one map overlaid with another, later keys winning."""
    return merge_last_wins(base, patch)


def append_tags(df: DataFrame, by: str = "job_id", order: str = "seq", tags: str = "tags") -> DataFrame:
    """Tags appended in option order, duplicates kept, as (by, pos, tag).

    Positions come from a running sum of earlier tag counts per job (the
    bucketed scan, so a job with a huge share of the rows is split over
    many tasks); no job's tags are ever collected into one array.
    """
    from jobledger.plans import scan

    src = df.select(by, order, F.coalesce(F.col(tags), F.array().cast("array<string>")).alias(tags))
    with_base = scan.running(src, by, [order], F.size(tags), "_base", inclusive=False)
    return with_base.select(by, F.posexplode(tags).alias("_i", "tag"), "_base").select(
        by, (F.col("_base") + F.col("_i")).cast("bigint").alias("pos"), "tag")


# --- P8 -----------------------------------------------------------------------

def expire_jobs(df: DataFrame, as_of, state: str = "state", expires_at: str = "expires_at") -> DataFrame:
    """A job whose ``expires_at`` has passed and is not terminal is discarded."""
    expired = _c(expires_at).isNotNull() & (_c(expires_at) < ts_lit(as_of)) & ~is_terminal(state)
    return (df.withColumn("expired", F.coalesce(expired, F.lit(False)))
              .withColumn(state, F.when(F.col("expired"), F.lit("discarded")).otherwise(_c(state))))


# --- P9 / P10 / P11 -----------------------------------------------------------

def decode_args(df: DataFrame, col: str = "args", out: str = "args_map") -> DataFrame:
    """Wire args text -> MAP<STRING,VARIANT> (the text is parsed once,
    into a named intermediate column, then read by the decoding branches)."""
    return (df.withColumn("_args_v", A.parse(col))
              .withColumn(out, A.decode_args_variant("_args_v")).drop("_args_v"))


def encode_args(df: DataFrame, col: str = "args_map", out: str = "args_wire") -> DataFrame:
    """P10: MAP -> wire args text."""
    return df.withColumn(out, A.encode_args(col))


_INT_TYPES = ("tinyint", "smallint", "int", "bigint", "integer", "long", "short", "byte")
_NUM_TYPES = ("float", "double")


def _field_check(raw: Column, dtype: str) -> Column:
    """True when the JSON value of ``raw`` can fill a field of ``dtype``."""
    kind = F.schema_of_variant(raw)
    numeric = kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    d = dtype.lower()
    if d in _INT_TYPES:
        val = F.try_variant_get(raw, "$", "double")
        return numeric & (val == F.floor(val))
    if d in _NUM_TYPES or d.startswith("decimal"):
        return numeric
    if d == "string":
        return kind == "STRING"
    if d == "boolean":
        return kind == "BOOLEAN"
    if d.startswith("struct"):
        return kind.startswith("OBJECT")
    if d.startswith("array"):
        return kind.startswith("ARRAY")
    if d.startswith("map"):
        return kind.startswith("OBJECT")
    return F.lit(True)


def typed_args(df: DataFrame, job_type: str, fields: list[tuple[str, str]], col: str = "args_map") -> DataFrame:
    """Decode the args map into a declared struct.

    ``fields`` is ``[(name, spark_type), ...]``. A present, non-null value of
    the wrong JSON type fails the row (``args_error``, non-retryable); a
    missing or null value takes the type's zero value.
    """
    obj = F.parse_json(F.to_json(_c(col)))
    zero = {"string": F.lit(""), "boolean": F.lit(False)}
    checks, values = [], []
    for name, dtype in fields:
        raw = F.try_variant_get(obj, f"$['{name}']", "variant")
        present = raw.isNotNull() & ~F.is_variant_null(raw)
        bad = present & ~F.coalesce(_field_check(raw, dtype), F.lit(False))
        checks.append(F.when(bad, F.lit(f"field {name}: wrong JSON type for {dtype}")))
        dz = zero.get(dtype.lower(), F.lit(0) if dtype.lower() in _INT_TYPES + _NUM_TYPES else F.lit(None))
        values.append(F.coalesce(F.try_variant_get(raw, "$", dtype), dz.cast(dtype)).alias(name))
    first_bad = F.coalesce(*checks) if checks else F.lit(None).cast("string")
    err = F.when(first_bad.isNotNull(), F.concat(F.lit(f"unmarshal args for {job_type}: "), first_bad))
    return (df.withColumn("args_error", err)
              .withColumn("args_typed", F.when(err.isNull(), F.struct(*values)))
              .withColumn("args_retryable", F.when(err.isNotNull(), F.lit(False))))


# --- P12 ----------------------------------------------------------------------

def _canon_literal(value) -> Column:
    return A.canonical_json(F.lit(json.dumps(value, sort_keys=True)))


def match_jobs(df: DataFrame, job_type: str, queue: str | None = None, args: dict | None = None,
               meta: dict | None = None, args_col: str = "args_map", meta_col: str = "meta") -> DataFrame:
    """Jobs of ``job_type`` (and queue) whose args equal ``args`` as JSON
    and whose meta contains every expected key (a missing key equals null)."""
    cond = F.col("type") == F.lit(job_type)
    if queue:
        cond = cond & (F.col("queue") == F.lit(queue))
    if args is not None:
        actual = F.to_json(A.sorted_map(F.coalesce(F.col(args_col), F.create_map().cast(A.ARGS_MAP))))
        cond = cond & (A.canonical_json(actual) == _canon_literal(args))
    if meta is not None:
        m = A.parse(meta_col)
        for k, v in meta.items():
            got = F.coalesce(F.to_json(F.try_variant_get(m, f"$['{k}']", "variant")), F.lit("null"))
            cond = cond & (got == _canon_literal(v))
    return df.filter(cond)


# --- P13 / P14 / P15 ----------------------------------------------------------

def classify_errors(df: DataFrame, code: str = "code", status: str = "status") -> DataFrame:
    """Sentinel class per error row (code first, then HTTP 409)."""
    return df.withColumn("error_class", E.error_class(code, status))


def api_retryable(df: DataFrame, kind: str = "error_kind", retryable: str = "retryable") -> DataFrame:
    """Retryability as the API client sees it (default false)."""
    return df.withColumn("is_retryable", E.api_retryable(kind, retryable))


def handler_retryable(df: DataFrame, kind: str = "error_kind") -> DataFrame:
    """Retryability as a worker sees a handler error (default true)."""
    return df.withColumn("is_retryable", E.handler_retryable(kind))


# --- P16 / P17 / P18 ----------------------------------------------------------

def ensure_trace_id(df: DataFrame, id_col: str = "job_id", meta: str = "meta") -> DataFrame:
    """Keep ``meta['trace_id']`` when present, else add a deterministic
    one (md5 of the job id) so reruns of the job keep the same trace."""
    current = F.col(meta)["trace_id"]
    trace = F.coalesce(current, F.md5(F.col(id_col).cast("string")))
    patch = F.create_map(F.lit("trace_id"), trace)
    return df.withColumn(meta, merge_last_wins(F.col(meta), patch))


def to_spans(attempts: DataFrame, prefix: str = K.SPAN_PREFIX) -> DataFrame:
    """One consumer span per attempt (needs type and queue on the row)."""
    ok = F.col("outcome") == "completed"
    return attempts.select(
        "job_id", "attempt",
        F.concat(F.lit(prefix), F.col("type")).alias("span_name"),
        F.lit("consumer").alias("span_kind"),
        F.col("type").alias("attr_job_type"),
        F.col("job_id").cast("string").alias("attr_job_id"),
        F.col("queue").alias("attr_job_queue"),
        F.col("attempt").cast("int").alias("attr_job_attempt"),
        F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        F.when(ok, F.lit("")).otherwise(F.coalesce(F.col("error_code"), F.lit(K.ERR_HANDLER_ERROR)))
         .alias("status_message"),
        F.col("started_at").alias("start_time"),
        plus_ms("started_at", "duration_ms").alias("end_time"),
    )


def to_execution_log(attempts: DataFrame) -> DataFrame:
    """A DEBUG start line and an INFO/ERROR end line per attempt.

    ``duration_ms`` = whole microseconds / 1000 on the end line only.
    """
    ok = F.col("outcome") == "completed"
    common = [F.col("type").alias("job_type"), F.col("job_id").cast("string").alias("log_job_id"),
              F.col("queue").alias("job_queue"), F.col("attempt").cast("int").alias("job_attempt")]
    start = F.struct(F.lit(0).alias("seq"), F.lit("DEBUG").alias("level"), F.lit("job started").alias("msg"),
                     F.col("started_at").alias("time"), F.lit(None).cast("double").alias("duration_ms"),
                     F.lit(None).cast("string").alias("error"))
    dur = F.floor(F.col("duration_ms") * 1000) / F.lit(1000.0)
    end = F.struct(F.lit(1).alias("seq"), F.when(ok, "INFO").otherwise("ERROR").alias("level"),
                   F.when(ok, "job completed").otherwise("job failed").alias("msg"),
                   plus_ms("started_at", "duration_ms").alias("time"), dur.alias("duration_ms"),
                   F.when(~ok, F.coalesce(F.col("error_code"), F.lit(K.ERR_HANDLER_ERROR))).alias("error"))
    return attempts.select(*common, F.explode(F.array(start, end)).alias("e")).select(
        "job_type", "log_job_id", "job_queue", "job_attempt",
        F.col("e.seq").alias("line"), F.col("e.level").alias("level"), F.col("e.msg").alias("msg"),
        F.col("e.time").alias("time"), F.col("e.duration_ms").alias("duration_ms"),
        F.col("e.error").alias("error"))
