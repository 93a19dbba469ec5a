"""The three end-to-end flows of the protocol, composed from the operators

* ``submit_requests``: args decoded, options and run time resolved, batches
  validated atomically, accepted requests materialised as jobs, duplicates
  resolved under the unique policy.
* ``run_jobs``: paused queues dropped, work ranked per queue, routed to
  handlers, handlers run, ack / nack applied, retries scheduled.
* ``create_workflows``: definitions expanded to steps, readiness and
  workflow state derived.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.operators import aggregations as AG
from jobledger.operators import joins as J
from jobledger.operators import process as X
from jobledger.operators import projections as P
from jobledger.operators import registry as U
from jobledger.operators import unique as UQ
from jobledger.operators import windows as W
from jobledger.operators import workflows as WF
from jobledger.functions.timecols import plus_ms, ts_lit
from jobledger.plans.stages import StageChain


def submit_requests(requests: DataFrame, unique_period_ms: int | None = None, unique_fields: list[str] | None = None,
                    on_conflict: str = "reject", prefix: str = "job-") -> tuple[DataFrame, DataFrame]:
    """``requests`` (``request_id, batch_id, seq, type, queue, args, created_at``
    and optional option columns) -> ``(jobs, batches)``.

    Jobs carry ids ``<prefix><n:06d>`` in request order, resolved options
    (``wire_options``), the default queue, state ``available`` (``scheduled``
    when a run time lies after ``created_at``) and, with a unique policy, only the surviving request of
    each slot (``unique_status`` tells the others apart)."""
    cols = set(requests.columns)
    r = P.decode_args(requests)
    if {"delay_ms", "scheduled_at", "delay_pos", "scheduled_pos"} <= cols:
        r = P.resolve_run_at(r).withColumn("delay_until", F.col("run_at"))
    batches, accepted = AG.enqueue_batch(r)
    # an invalid queue fails its batch; only then is the default filled in
    accepted = P.resolve_options(accepted)
    jobs = U.materialise_jobs(accepted, prefix=prefix)
    if "run_at" in jobs.columns:
        jobs = jobs.withColumn("state", F.when(F.col("run_at") > F.col("created_at"), F.lit("scheduled"))
                               .otherwise(F.col("state")))
    if unique_period_ms is not None:
        folded = UQ.apply_unique(jobs, unique_period_ms, on_conflict, fields=unique_fields)
        jobs = folded.withColumnRenamed("status", "unique_status")
    return jobs, batches


def run_jobs(jobs: DataFrame, queues: DataFrame, handlers: dict[str, Callable], per_queue: int,
             middleware: StageChain | None = None, policy: dict | None = None, as_of=None) -> DataFrame:
    """One dispatch round over a job table: the top ``per_queue`` available
    jobs of every active queue are run by their handlers; the result is the
    job table after ack / nack with the retry time of nacked jobs.

    ``jobs``: ``job_id, type, queue, priority, created_at, state, attempt,
    max_attempts`` (+ ``args``)."""
    p = {"initial_interval_ms": K.DEFAULT_INITIAL_INTERVAL_MS, "backoff_coefficient": K.DEFAULT_BACKOFF_COEFFICIENT,
         "max_interval_ms": K.DEFAULT_MAX_INTERVAL_MS, **(policy or {})}
    picked = W.dispatch(J.drop_paused(jobs, queues), queues, per_queue, per_queue=True).drop("rank")
    picked = picked.withColumn("attempt", F.col("attempt") + 1)
    routed = J.route(picked, _handler_frame(jobs, handlers))
    # jobs without a handler are nacked by the router (not retryable) and never run
    unrouted = routed.filter(~F.col("routed")).select(
        F.col("job_id").cast("string").alias("job_id"), F.lit("nack").alias("kind"),
        F.lit(None).cast("string").alias("result"),
        F.struct(F.col("error_code").alias("code"), F.col("error_message").alias("message"),
                 F.col("error_retryable").alias("retryable")).alias("error"))
    ran = X.process(routed.filter(F.col("routed")), handlers, middleware=middleware)
    outcomes = ran.select(
        F.col("job_id"), F.when(F.col("state") == "completed", "ack").otherwise("nack").alias("kind"),
        F.col("result"),
        F.when(F.col("state") != "completed", F.struct(F.col("error_code").alias("code"),
                                                        F.col("error_message").alias("message"),
                                                        F.col("error_retryable").alias("retryable"))).alias("error")
    ).unionByName(unrouted)
    started = picked.select(F.col("job_id").cast("string").alias("job_id"), F.col("attempt").alias("_attempt"))
    active = jobs.withColumn("job_id", F.col("job_id").cast("string")).join(started, "job_id", "left")
    active = active.withColumn("state", F.when(F.col("_attempt").isNotNull(), F.lit("active")).otherwise(F.col("state")))
    active = active.withColumn("attempt", F.coalesce("_attempt", F.col("attempt"))).drop("_attempt")
    after = J.apply_outcomes(active, outcomes)
    delay = F.floor(W.retry_delay_ms(F.col("attempt"), p["initial_interval_ms"], p["backoff_coefficient"],
                                     p["max_interval_ms"])).cast("bigint")
    now = ts_lit(as_of) if as_of is not None else F.col("created_at")
    return after.withColumn("next_run_at", F.when(F.col("state") == "retryable", plus_ms(now, delay)))


def _handler_frame(jobs: DataFrame, handlers: dict[str, Callable]) -> DataFrame:
    from jobledger.plans.strategy import literal_frame
    return literal_frame(jobs.sparkSession, [(t,) for t in handlers], "type string")


def create_workflows(defs: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Definitions -> ``(steps, ready, state)``: the expanded steps (all
    ``pending``), which of them may start, and each workflow's state.
    ``parts``: as in ``ready_steps``."""
    steps = WF.expand_workflows(defs).withColumn("state", F.lit("pending"))
    ready = J.ready_steps(steps.select("workflow_id", "step_id", "depends_on", "state"), parts)
    state = WF.workflow_state(steps.select("workflow_id", "step_id", "state"))
    return steps, ready, state
