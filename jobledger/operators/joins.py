"""Joins between the job ledger and its command / dimension tables.

Equi-joins on job or workflow keys; Catalyst chooses broadcast vs
sort-merge from measured sizes (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.functions.timecols import ts_lit
from jobledger.operators.projections import is_terminal
from jobledger.plans.strategy import dealt


def route(jobs: DataFrame, handlers: DataFrame) -> DataFrame:
    """Attach each job to its handler type; a job without one gets
    ``handler_error`` (not retryable) and the message
    ``no handler registered for job type "<type>"``."""
    reg = handlers.select(F.col("type").alias("_handler")).distinct()
    j = jobs.join(reg, jobs["type"] == reg["_handler"], "left")
    missing = F.col("_handler").isNull()
    return j.select(
        *jobs.columns,
        (~missing).alias("routed"),
        F.when(missing, F.lit(K.ERR_HANDLER_ERROR)).alias("error_code"),
        F.when(missing, F.concat(F.lit('no handler registered for job type "'), F.col("type"), F.lit('"')))
         .alias("error_message"),
        F.when(missing, F.lit(False)).alias("error_retryable"),
    )


def _lookup(jobs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``ids LEFT JOIN jobs`` without shuffling the whole job table for a
    short id list: the inner join first narrows ``jobs`` (either side may be
    broadcast by AQE, so a small id list is broadcast and ``jobs`` streams
    in place), then the ids are left-joined to that narrow result."""
    wanted = ids.select(key).distinct()
    found = jobs.join(wanted, key, "inner").withColumn("_found", F.lit(True))
    return ids.select(key).join(found, key, "left")


def get_jobs(jobs: DataFrame, ids: DataFrame, key: str = "job_id") -> DataFrame:
    """Look up jobs by id; an unknown id yields ``not_found``."""
    j = _lookup(jobs, ids, key)
    return j.withColumn("error_code", F.when(F.col("_found").isNull(), F.lit(K.ERR_NOT_FOUND))).drop("_found")


def apply_outcomes(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Apply ack / nack rows to active jobs.

    ack -> ``completed`` with its result; nack -> the error struct is stored
    and the job becomes ``retryable`` when the error is retryable and
    attempts remain, else ``discarded`` (W2 plans the retry time).
    Jobs that are not active, or have no outcome, are unchanged. Of several
    outcomes of a job one counts: the first by the ``seq`` column where there
    is one (the server settles a job once), else ack before nack, then the
    smallest result and error code.
    """
    seq = [F.col("seq")] if "seq" in outcomes.columns else []
    first = F.struct(*seq, F.col("kind") != "ack", F.coalesce(F.col("result"), F.lit("")),
                     F.coalesce(F.col("error.code"), F.lit("")), F.coalesce(F.col("error.message"), F.lit("")))
    o = outcomes.filter(F.col("kind").isin("ack", "nack")).groupBy("job_id").agg(
        F.min_by(F.struct(F.col("kind"), F.col("result"), F.col("error")), first).alias("_o"))
    o = o.select("job_id", F.col("_o.kind").alias("_kind"), F.col("_o.result").alias("_result"),
                 F.col("_o.error").alias("_error"))
    j = jobs.join(o, "job_id", "left")
    active = F.col("state") == "active"
    ack = active & (F.col("_kind") == "ack")
    nack = active & (F.col("_kind") == "nack")
    retry = F.coalesce(F.col("_error.retryable"), F.lit(False)) & (F.col("attempt") < F.col("max_attempts"))
    state = (F.when(ack, F.lit("completed"))
              .when(nack, F.when(retry, F.lit("retryable")).otherwise(F.lit("discarded")))
              .otherwise(F.col("state")))
    return j.select(
        *[c for c in jobs.columns if c != "state"], state.alias("state"),
        F.when(ack, F.col("_result")).alias("result"),
        F.when(nack, F.col("_error")).alias("error"))


def cancel_jobs(jobs: DataFrame, ids: DataFrame, as_of, key: str = "job_id") -> DataFrame:
    """Cancel commands. One row per command: the job's previous state,
    the new state and ``cancelled_at``; terminal jobs are refused with a
    conflict and unknown ids with ``not_found``."""
    j = _lookup(jobs.select(key, "state"), ids, key)
    found = F.col("_found").isNotNull()
    term = is_terminal("state")
    ok = found & ~term
    return j.select(
        key,
        F.col("state").alias("previous_state"),
        F.when(ok, F.lit("cancelled")).otherwise(F.col("state")).alias("state"),
        F.when(ok, ts_lit(as_of)).alias("cancelled_at"),
        F.when(~found, F.lit(K.ERR_NOT_FOUND)).when(term, F.lit("conflict")).alias("error_code"),
    )


def drop_paused(jobs: DataFrame, queues: DataFrame) -> DataFrame:
    """Jobs whose queue is not paused (left-anti join on the queue)."""
    paused = queues.filter(F.col("status") == "paused").select("queue")
    return jobs.join(paused, "queue", "left_anti")


def _dep_state(steps: DataFrame, parts: int | None = None) -> DataFrame:
    """(workflow_id, step_id, dep_id, dep_state) per dependency edge."""
    edges = steps.select("workflow_id", "step_id", F.explode_outer("depends_on").alias("dep_id"))
    deps = steps.select("workflow_id", F.col("step_id").alias("dep_id"), F.col("state").alias("dep_state"))
    keys = ["workflow_id", "dep_id"]
    return dealt(edges, parts, *keys).join(dealt(deps, parts, *keys), keys, "left")


def ready_steps(steps: DataFrame, parts: int | None = None) -> DataFrame:
    """Whether each step's dependencies allow it to run.

    Ordinary steps need every dependency ``completed``. The batch callbacks
    carry no condition on the wire, so they are special-cased by id:
    ``on-complete`` needs all dependencies terminal, ``on-success`` all
    completed, ``on-failure`` all terminal and one discarded or cancelled.
    A step without dependencies is ready. ``parts``: partitions for the join
    and the grouping of a large step table (``strategy.parts_for``).
    """
    e = dealt(_dep_state(steps, parts), parts, "workflow_id", "step_id")
    has = F.col("dep_id").isNotNull()
    done = F.col("dep_state") == "completed"
    term = F.coalesce(F.col("dep_state").isin(*K.TERMINAL_STATES), F.lit(False))
    bad = F.coalesce(F.col("dep_state").isin("discarded", "cancelled"), F.lit(False))
    g = e.groupBy("workflow_id", "step_id").agg(
        F.count_if(has).alias("n_deps"),
        F.count_if(has & F.coalesce(done, F.lit(False))).alias("n_done"),
        F.count_if(has & term).alias("n_term"),
        F.count_if(has & bad).alias("n_bad"))
    sid = F.col("step_id")
    ready = (F.when(sid == "on-complete", F.col("n_term") == F.col("n_deps"))
              .when(sid == "on-success", F.col("n_done") == F.col("n_deps"))
              .when(sid == "on-failure", (F.col("n_term") == F.col("n_deps")) & (F.col("n_bad") > 0))
              .otherwise(F.col("n_done") == F.col("n_deps")))
    return g.select("workflow_id", "step_id", "n_deps", "n_done", ready.alias("ready"))


def parent_results(steps: DataFrame, as_map: bool = False) -> DataFrame:
    """The results of each step's upstream steps.

    Long form by default (one row per edge), so a callback that depends on
    every job of a huge batch is never gathered in one row; ``as_map``
    builds ``MAP<step_id, result>`` per step for bounded fan-in.
    """
    edges = steps.select("workflow_id", "step_id", F.explode("depends_on").alias("parent_id"))
    res = steps.select("workflow_id", F.col("step_id").alias("parent_id"), F.col("result").alias("parent_result"))
    long = edges.join(res, ["workflow_id", "parent_id"], "left")
    if not as_map:
        return long
    return long.groupBy("workflow_id", "step_id").agg(
        F.map_from_entries(F.collect_list(F.struct("parent_id", "parent_result"))).alias("parent_results"))


def stale_jobs(jobs: DataFrame, heartbeats: DataFrame, as_of, default_timeout_ms: int = 30_000) -> DataFrame:
    """Active jobs with no heartbeat listing them within their visibility
    timeout before ``as_of`` are reclaimable.

    Heartbeats are exploded to (job, ts) and reduced to the latest per job
    (partial aggregation) before the join, so the join sees one row per job.
    """
    hi = ts_lit(as_of)
    hb = (heartbeats.filter(F.col("ts") <= hi)
          .select(F.explode("active_job_ids").alias("job_id"), "ts")
          .groupBy("job_id").agg(F.max("ts").alias("last_heartbeat")))
    active = jobs.filter(F.col("state") == "active")
    cols = set(jobs.columns)
    vt = F.coalesce(F.col("visibility_timeout_ms"), F.lit(default_timeout_ms)) if "visibility_timeout_ms" in cols \
        else F.lit(default_timeout_ms)
    j = active.join(hb, "job_id", "left")
    limit = hi - F.make_dt_interval(secs=vt.cast("decimal(38,3)") / 1000)
    stale = F.col("last_heartbeat").isNull() | (F.col("last_heartbeat") < limit)
    return j.select("job_id", "last_heartbeat", vt.alias("visibility_timeout_ms"), stale.alias("reclaimable"))


def _json_type_ok(kind, expected):
    numeric = kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    return (F.when(expected == "string", kind == "STRING")
             .when(expected == "boolean", kind == "BOOLEAN")
             .when(expected == "null", kind == "VOID")
             .when(expected == "number", numeric)
             .when(expected == "integer", numeric & ~kind.rlike(r"^(DOUBLE|FLOAT)") &
                   ~kind.rlike(r"^DECIMAL\(\d+,[1-9]"))
             .when(expected == "object", kind.startswith("OBJECT"))
             .when(expected == "array", kind.startswith("ARRAY"))
             .otherwise(F.lit(True)))


def validate_payloads(jobs: DataFrame, schemas: DataFrame, args: str = "args_map") -> DataFrame:
    """Check job args against the schema registered for the job type:
    every ``required`` key present, and each listed property of the declared
    top-level JSON type. A job naming a schema URI is checked against that
    one; naming none, against the latest ``version`` of its type (versions
    compare by their numbers, then by text; equal ones by URI). A URI that is
    not registered fails with ``schema_validation``. Types without a schema
    pass."""
    cols = set(jobs.columns)
    named = F.col("schema_uri") if "schema_uri" in cols else F.lit(None).cast("string")
    version = F.col("version") if "version" in schemas.columns else F.lit(None).cast("string")
    numbers = F.transform(F.regexp_extract_all(F.coalesce(version, F.lit("")), F.lit(r"(\d+)"), 1), lambda x: x.cast("decimal(38,0)"))
    one = F.struct(F.col("uri").alias("uri"), F.col("schema").alias("schema"))
    latest = schemas.groupBy("type").agg(F.max_by(one, F.struct(numbers, version, F.col("uri"))).alias("_l"))
    by_type = latest.select(F.col("type").alias("_stype"), F.col("_l.uri").alias("_turi"), F.col("_l.schema").alias("_tschema"))
    by_uri = schemas.filter("uri IS NOT NULL").groupBy(F.col("uri").alias("_uri")).agg(
        F.max_by("schema", F.struct(numbers, version, F.col("schema"))).alias("_uschema"))
    j = jobs.withColumn("_named", named)
    j = j.join(by_uri, F.col("_named") == F.col("_uri"), "left").join(by_type, F.col("type") == F.col("_stype"), "left")
    j = j.withColumn("_suri", F.when(F.col("_named").isNull(), F.col("_turi")).otherwise(F.col("_uri")))
    j = j.withColumn("_s", F.from_json(F.when(F.col("_named").isNull(), F.col("_tschema")).otherwise(F.col("_uschema")),
                                       "struct<required: array<string>, properties: map<string, struct<type: string>>>"))
    m = F.col(args)
    missing = F.filter(F.coalesce(F.col("_s.required"), F.array().cast("array<string>")),
                       lambda k: ~F.coalesce(F.map_contains_key(m, k), F.lit(False)))
    props = F.map_entries(F.coalesce(F.col("_s.properties"), F.create_map().cast("map<string,struct<type:string>>")))
    wrong = F.filter(props, lambda p: F.map_contains_key(m, p["key"]) & ~F.is_variant_null(m[p["key"]]) &
                     ~_json_type_ok(F.schema_of_variant(m[p["key"]]), p["value"]["type"]))
    uri_bad = F.col("_named").isNotNull() & F.col("_uri").isNull()
    err = (F.when(uri_bad, F.lit("schema not registered"))
            .when(F.size(missing) > 0, F.concat(F.lit("missing required field "), F.get(missing, 0)))
            .when(F.size(wrong) > 0, F.concat(F.lit("field "), F.get(wrong, 0)["key"], F.lit(": expected "),
                                              F.get(wrong, 0)["value"]["type"])))
    return j.select(*jobs.columns, F.col("_suri").alias("schema_uri_matched"), err.isNull().alias("valid"),
                    F.when(err.isNotNull(), F.lit(K.ERR_SCHEMA_VALIDATION)).alias("error_code"),
                    err.alias("error_message"))
