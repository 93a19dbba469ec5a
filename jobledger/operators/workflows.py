"""Workflow expansion and rollups.

A workflow definition row already holds its steps as an array, so expansion
is one per-row ``posexplode`` of steps and callbacks (no shuffle). Rollups group steps by workflow
with ``count_if`` / ``bool_and`` (partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from jobledger import constants as K
from jobledger.operators import projections as P

STEP = "struct<type:string,args:string,queue:string,timeout_ms:bigint,priority:int>"


def _wire_args(args_json) -> "F.Column":
    """An args object (JSON text) in wire form: ``[]`` or ``[{...}]``.

    ``to_json(parse_json(x))`` already writes object keys sorted (the
    encoder's order), so no per-entry sort is needed; a missing, empty or
    non-object value is written as ``[]``."""
    canon = F.to_json(F.try_parse_json(args_json))
    is_obj = canon.startswith("{") & (canon != "{}")
    return F.when(F.coalesce(is_obj, F.lit(False)), F.concat(F.lit("["), canon, F.lit("]"))).otherwise(F.lit("[]"))


# options a step or a workflow may give -> type where its struct lacks the field
OPTION_FIELDS = {"queue": "string", "priority": "int", "timeout_ms": "bigint", "visibility_timeout_us": "bigint",
                 "delay_until": "timestamp", "expires_at": "timestamp", "retry": P.RETRY_TYPE, "unique": P.UNIQUE_TYPE,
                 "tags": "array<string>"}


def _option_struct(s, fields: set[str]) -> "F.Column":
    """The options that struct ``s`` gives, in one shape; fields it lacks are
    NULL. A timeout comes in milliseconds, or as ``timeout_us``."""
    def field(name, dtype):
        if name == "timeout_ms" and name not in fields and "timeout_us" in fields:
            return P._trunc_ms(s["timeout_us"])
        return s[name] if name in fields else F.lit(None).cast(dtype)

    return F.struct(*[field(n, t).alias(n) for n, t in OPTION_FIELDS.items()])


def _with_wire_options(df: DataFrame, col: str) -> DataFrame:
    """``df`` with ``wire_options``: all nine options of struct ``col`` in wire
    form, where its queue is given and not the default or it has a timeout;
    else NULL, whatever else it gives."""
    o = F.col(col)
    keep = (F.coalesce(o["queue"], F.lit(K.DEFAULT_QUEUE)) != K.DEFAULT_QUEUE) | (F.coalesce(o["timeout_ms"], F.lit(0)) > 0)
    names = {n: o[n] for n in OPTION_FIELDS if n != "timeout_ms"}
    wire = P.wire_options(df, timeout_us=o["timeout_ms"] * 1000, **names)
    return df.withColumn("wire_options", F.when(F.coalesce(keep, F.lit(False)), wire))


def _fields(df: DataFrame, *path: str) -> set[str]:
    """Field names of a struct, or of an array's structs, in ``df``."""
    t = df.schema
    for p in path:
        t = t[p].dataType
        t = t.elementType if isinstance(t, ArrayType) else t
    return set(t.names)


def expand_workflows(defs: DataFrame) -> DataFrame:
    """G1: definitions -> step rows ``(workflow_id, pos, step_id, type,
    args, depends_on, options)``.

    ``chain``: ``step-i`` after ``step-(i-1)``, with the step's own options
    (any of ``OPTION_FIELDS``; see ``_with_wire_options``); ``group``:
    ``job-i`` without dependencies or options; ``batch``: ``job-i`` plus the
    present callbacks ``on-complete`` / ``on-success`` / ``on-failure``, each
    depending on all jobs. Unknown kinds and missing steps give no rows.

    Steps and callbacks of a definition form one array and are unnested
    once: the input is read once and nothing is shuffled.
    """
    kind, steps = F.col("kind"), F.col("steps")
    given = _fields(defs, "steps")
    is_chain, no_deps = kind == "chain", F.array().cast("array<string>")
    none = F.lit(None).cast(f"struct<{','.join(f'{n}:{t}' for n, t in OPTION_FIELDS.items())}>")

    def row(step_id, typ, args, deps, options):
        return F.struct(step_id.alias("step_id"), typ.alias("type"), args.alias("args"), deps.alias("depends_on"),
                        options.alias("opts"))

    def main(s, i):
        before = F.concat(F.lit("step-"), (i - 1).cast("string"))
        return row(F.concat(F.when(is_chain, "step-").otherwise("job-"), i.cast("string")), s["type"], s["args"],
                   F.when(is_chain & (i > 0), F.array(before)).otherwise(no_deps),
                   F.when(is_chain, _option_struct(s, given)).otherwise(none))

    n = F.greatest(F.coalesce(F.size(steps), F.lit(0)), F.lit(0))
    jobs = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("job-"), i.cast("string")))).otherwise(no_deps)
    cb = F.col("callbacks")
    calls = F.array(*[F.when((kind == "batch") & cb[f].isNotNull(), row(F.lit(sid), cb[f]["type"], cb[f]["args"], jobs, none))
                      for f, sid in zip(["on_complete", "on_success", "on_failure"], K.CALLBACK_STEPS)])
    calls = F.filter(calls, lambda c: c.isNotNull())
    own = F.coalesce(F.transform(steps, main), F.filter(calls, lambda c: F.lit(False)))
    rows = defs.filter(kind.isin("chain", "group", "batch")).select(
        "workflow_id", F.posexplode(F.concat(own, calls)).alias("pos", "s"))
    rows = rows.select("workflow_id", F.col("pos").cast("int").alias("pos"), "s.*")
    return _with_wire_options(rows, "opts").select(
        "workflow_id", "pos", "step_id", "type", _wire_args(F.col("args")).alias("args"), "depends_on",
        F.col("wire_options").alias("options"))


def workflow_requests(defs: DataFrame) -> DataFrame:
    """G1, one row a definition: its ``name``, the number of its steps with
    callbacks, and its own options (struct ``options`` with any of
    ``OPTION_FIELDS``) in wire form under the rule of a chain's steps. An
    unknown kind is a request without steps. A per-row projection."""
    cb = F.col("callbacks")
    calls = sum((F.when(cb[f].isNotNull(), 1).otherwise(0) for f in ("on_complete", "on_success", "on_failure")), F.lit(0))
    n = F.greatest(F.coalesce(F.size("steps"), F.lit(0)), F.lit(0))
    n = F.when(F.col("kind") == "batch", n + calls).when(F.col("kind").isin("chain", "group"), n).otherwise(0)
    opts = _option_struct(F.col("options"), _fields(defs, "options"))
    r = _with_wire_options(defs.withColumn("_opts", opts), "_opts")
    return r.select("workflow_id", "name", "kind", n.cast("int").alias("n_steps"), F.col("wire_options").alias("options"))


def _is_callback(col="step_id"):
    return F.col(col).isin(*K.CALLBACK_STEPS)


def workflow_state(steps: DataFrame, cancelled: DataFrame | None = None) -> DataFrame:
    """A7 (ours): ``cancelled`` if marked; ``failed`` if any non-callback step
    is discarded; ``completed`` if all job steps completed and so have the
    callbacks that this fires (``on-complete`` and ``on-success``; an
    ``on-failure`` step stays pending in a successful batch); ``running``
    once any step has left ``pending``; else ``pending``."""
    never = F.col("step_id") == "on-failure"
    g = steps.groupBy("workflow_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(~_is_callback() & (F.col("state") == "discarded")).alias("n_failed"),
        F.count_if(F.col("state") == "completed").alias("n_completed"),
        F.count_if(~never & ~F.col("state").eqNullSafe("completed")).alias("n_open"),
        F.count_if(F.col("state") != "pending").alias("n_started"))
    if cancelled is not None:
        g = g.join(cancelled.select("workflow_id").distinct().withColumn("_cancelled", F.lit(True)),
                   "workflow_id", "left")
    else:
        g = g.withColumn("_cancelled", F.lit(None).cast("boolean"))
    state = (F.when(F.coalesce(F.col("_cancelled"), F.lit(False)), F.lit("cancelled"))
              .when(F.col("n_failed") > 0, F.lit("failed"))
              .when(F.col("n_open") == 0, F.lit("completed"))
              .when(F.col("n_started") > 0, F.lit("running"))
              .otherwise(F.lit("pending")))
    return g.select("workflow_id", state.alias("state"), "steps", "n_completed", "n_failed")


def batch_callbacks(steps: DataFrame) -> DataFrame:
    """A8 (ours): callbacks that fire per workflow, from its job steps
    (callback steps themselves excluded): all terminal -> ``on-complete``;
    all completed -> ``on-success``; all terminal and any discarded or
    cancelled -> ``on-failure``. Only callbacks that the workflow defines (its
    callback steps) fire. A batch of zero jobs fires complete and success."""
    jobs = steps.withColumn("_job", ~_is_callback())
    g = jobs.groupBy("workflow_id").agg(
        F.count_if("_job").alias("n"),
        F.count_if(F.col("_job") & F.col("state").isin(*K.TERMINAL_STATES)).alias("n_term"),
        F.count_if(F.col("_job") & (F.col("state") == "completed")).alias("n_done"),
        F.count_if(F.col("_job") & F.col("state").isin("discarded", "cancelled")).alias("n_bad"),
        *[F.bool_or(F.col("step_id") == c).alias(f"_{i}") for i, c in enumerate(K.CALLBACK_STEPS)])
    all_term = F.col("n_term") == F.col("n")
    fired = F.array(
        F.when(F.col("_0") & all_term, F.lit("on-complete")),
        F.when(F.col("_1") & (F.col("n_done") == F.col("n")), F.lit("on-success")),
        F.when(F.col("_2") & all_term & (F.col("n_bad") > 0), F.lit("on-failure")))
    return g.select("workflow_id", F.explode(F.filter(fired, lambda x: x.isNotNull())).alias("callback"))


def cancel_workflows(steps: DataFrame, ids: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """Cancel workflows: their non-terminal steps become ``cancelled``.
    Returns ``(summary, steps)``; the summary counts the steps cancelled and
    those already completed per cancelled workflow."""
    marked = ids.select("workflow_id").distinct().withColumn("_cancel", F.lit(True))
    s = steps.join(marked, "workflow_id", "left")
    hit = F.coalesce(F.col("_cancel"), F.lit(False))
    open_ = ~F.col("state").isin(*K.TERMINAL_STATES)
    new_steps = s.withColumn("state", F.when(hit & open_, F.lit("cancelled")).otherwise(F.col("state")))
    summary = s.filter(hit).groupBy("workflow_id").agg(
        F.count_if(open_).alias("steps_cancelled"),
        F.count_if(F.col("state") == "completed").alias("steps_already_completed")
    ).withColumn("state", F.lit("cancelled"))
    return summary, new_steps.drop("_cancel")
