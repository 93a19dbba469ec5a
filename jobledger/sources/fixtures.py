"""Ledger-shaped inputs read from the driver tables (the FIXTURES.md views).

Each function builds one input table in the schema an operator expects: it
renames and re-types driver columns, and where the view defines it, numbers
the line items of an order as attempts (``attempts``) and summarises a job's
attempts into its attempt count, first start and state (``jobs``). They
prepare inputs only; the operators under test do their own work on them. The
same definitions exist as portable SQL in ``jobledger.oracle_views`` for the
DuckDB oracle.

Scale notes: ``attempts`` numbers line items per order with a window
partitioned by order key (one shuffle on ``l_orderkey``); ``jobs`` folds the
attempts per job with ``max_by``/``min`` (partial aggregation, no second
window) and joins orders to customers on their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobledger.plans.strategy import literal_frame
from jobledger.sources.tables import table


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per execution attempt (a line item of an order = job)."""
    li = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    flag = F.col("l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("job_id"),
        F.row_number().over(order).cast("int").alias("attempt"),
        F.col("l_shipdate").alias("started_at"),
        (F.floor("l_quantity").cast("bigint") * F.lit(1000)).alias("duration_ms"),
        F.when(flag == "N", "completed").otherwise("failed").alias("outcome"),
        F.when(flag == "R", "backend_error").when(flag == "A", "invalid_payload").alias("error_code"),
        (flag == "R").alias("retryable"),
        F.concat(F.lit("worker_host_a_"), F.col("l_suppkey").cast("string"), F.lit("_1")).alias("worker_id"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per job (an order); queue = the customer's market segment."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # the last attempt is the largest in the attempts' order: no window needed
    order = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    per_job = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("job_id")).agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.max_by(F.col("l_returnflag") == "N", order).alias("last_completed"),
        F.max_by(F.col("l_returnflag") == "R", order).alias("last_retryable"),
        F.min("l_shipdate").alias("first_started"),
    )
    joined = (o.join(c, o.o_custkey == c.c_custkey, "inner")
               .join(per_job, o.o_orderkey == per_job.job_id, "left"))
    status = F.col("o_orderstatus")
    state = (F.when(status == "O", "available")
              .when(status == "P", "active")
              .when(F.col("n").isNull(), "scheduled")
              .when(F.col("last_completed"), "completed")
              .when(F.coalesce(F.col("last_retryable"), F.lit(False)) & (F.col("n") < 3), "retryable")
              .otherwise("discarded"))
    return joined.select(
        F.col("o_orderkey").alias("job_id"),
        F.concat(F.lit("order."), F.lower(F.expr("substr(o_orderpriority, 3)"))).alias("type"),
        F.lower("c_mktsegment").alias("queue"),
        (F.lit(5) - F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority"),
        F.coalesce(F.col("n"), F.lit(0)).alias("attempt"),
        F.lit(3).alias("max_attempts"),
        state.alias("state"),
        F.col("o_orderdate").alias("created_at"),
        F.col("first_started").alias("started_at"),
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event envelopes (type, subject, time, data) read from the events table."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    typ = (F.when(et == "signup", "job.enqueued").when(et == "view", "job.started")
            .when(et == "click", "job.progress").when(et == "purchase", "job.completed")
            .otherwise("job.failed"))
    return e.select("event_id", typ.alias("type"), F.col("user_id").cast("string").alias("subject"),
                    F.col("ts").alias("time"), "value", F.col("props").alias("data"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enqueue requests, in batches of ten, some with invalid types or queues."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    queue = (F.when(eid % 97 == 0, "BadQueue")
              .when(F.col("user_id") % 7 == 0, "")
              .otherwise(F.concat(F.lit("q"), (F.col("user_id") % 5).cast("string"))))
    return e.select(
        eid.alias("request_id"),
        F.floor(eid / 10).cast("bigint").alias("batch_id"),
        (eid % 10).alias("seq"),
        F.concat(F.when(eid % 50 == 0, "Bad ").otherwise(""), F.lit("evt."), F.col("event_type")).alias("type"),
        queue.alias("queue"),
        F.concat(F.lit("["), F.col("props"), F.lit("]")).alias("args"),
        F.col("ts").alias("created_at"),
        F.concat(F.col("user_id").cast("string"), F.lit("|"), F.col("event_type")).alias("unique_key"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("delay_ms"),
    )


def meta_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"),
                    F.col("event_type").alias("meta_key"), F.col("props").alias("meta_value"))


def directives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    desired = (F.when(et == "view", "running").when(et == "click", "quiet")
                .when((et == "error") & (F.col("value") > 100), "terminate").otherwise("noop"))
    return e.select(F.col("user_id").alias("worker"), "event_id", "ts", desired.alias("desired"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("worker"), "event_id", "ts",
                    F.col("event_type").isin("error", "click").alias("failed"))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worker heartbeats; each carries the list of job ids it holds."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("worker_host_a_"), (F.col("user_id") % 8).cast("string"), F.lit("_1")).alias("worker_id"),
        "ts", "event_id",
        F.array(F.col("user_id")).alias("active_job_ids"),
    )


def workflow_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order read as a chain workflow of its line items."""
    a = attempts(spark, sf_dir)
    dep = F.when(F.col("attempt") > 1, F.array(F.concat(F.lit("job-"), (F.col("attempt") - 2).cast("string"))))
    state = (F.when(F.col("outcome") == "completed", "completed")
              .when(F.col("retryable"), "active").otherwise("discarded"))
    return a.select(
        F.col("job_id").alias("workflow_id"),
        F.concat(F.lit("job-"), (F.col("attempt") - 1).cast("string")).alias("step_id"),
        F.coalesce(dep, F.array().cast("array<string>")).alias("depends_on"),
        state.alias("state"),
    )


def batch_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order read as a batch workflow: its line items, one after the
    other, and the callbacks that some orders define, after all of them."""
    steps = workflow_steps(spark, sf_dir)
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    k = F.col("k")
    one = lambda when, name, done: F.when(when, F.struct(F.lit(name).alias("step_id"), F.when(done, "completed").otherwise("pending").alias("state")))
    defined = F.array(one(k % 2 == 0, "on-complete", k % 4 == 0), one(k % 3 == 0, "on-success", k % 9 != 0), one(k % 5 != 0, "on-failure", k % 7 == 0))
    jobs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.concat(F.lit("job-"), i.cast("string")))
    after = n.select(k.alias("workflow_id"), F.explode(F.filter(defined, lambda c: c.isNotNull())).alias("c"), jobs.alias("depends_on"))
    return steps.unionByName(after.select("workflow_id", F.col("c.step_id").alias("step_id"), "depends_on", F.col("c.state").alias("state")))


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured API responses: status, JSON error body, headers."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    status = (F.when(et == "error", 429).when(et == "click", 404).when(et == "purchase", 409)
               .when(et == "view", 500).otherwise(200))
    code = (F.when(et == "error", "rate_limited").when(et == "click", "not_found")
             .when(et == "purchase", "other").when(et == "view", "backend_error"))
    return e.select("event_id", "ts", status.alias("status"), code.alias("code"),
                    et.isin("error", "view").alias("retryable"), "value", "props")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages in batches of ten; every 31st body is not JSON."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    body = F.when(eid % 31 == 0, F.lit("{bad")).otherwise(F.concat(
        F.lit('{"id":"'), eid.cast("string"), F.lit('","type":"evt.'), F.col("event_type"),
        F.lit('","args":['), F.col("props"), F.lit("]}")))
    return e.select(F.floor(eid / 10).cast("bigint").alias("batch_id"),
                    F.concat(F.lit("msg-"), eid.cast("string")).alias("message_id"),
                    body.alias("body"))


def queues(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark,
        [("automobile", "active", 0), ("building", "paused", 1), ("furniture", "active", 2),
         ("household", None, 3), ("machinery", "paused", 4), ("idle", "active", 5), ("parked", "paused", 6)],
        "queue string, status string, ord int")


def cron_jobs(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark,
        [("daily-report", "0 9 * * *", "UTC", "report.generate"),
         ("nightly-cleanup", "0 2 * * *", "UTC", "cleanup.run"),
         ("weekly-digest", "30 6 * * 1", "UTC", "digest.send"),
         ("monthly-invoice", "0 0 1 * *", "UTC", "invoice.run"),
         ("odd-days", "*/20 8-9 */2 * *", "UTC", "probe.run"),
         ("friday-or-13th", "15 12 13 * 5", "UTC", "luck.check"),
         ("leap-day", "0 0 29 2 *", "UTC", "leap.run"),
         ("never", "0 0 31 2 *", "UTC", "never.run"),
         ("broken", "0 9 * * MON", "UTC", "broken.run")],
        "name string, cron string, timezone string, type string")


ZONES = ["UTC", "America/New_York", "Europe/Berlin", ""]


def schedules(spark: SparkSession, sf: str) -> DataFrame:
    """One schedule a customer, in the zone of the customer's nation, with the
    time it was last looked at; every tenth customer's text is no schedule."""
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    at = F.concat(text(k % 60), F.lit(" "), text(k % 24), F.lit(" "))
    form = k % 10
    cron = (F.when(form < 3, F.concat(at, F.lit("* * *")))
             .when(form < 6, F.concat(at, F.lit("* * "), text(k % 8)))
             .when(form == 6, F.concat(at, text(k % 31 + 1), F.lit(" * *")))
             .when(form == 7, F.concat(F.lit("*/20 1-3 "), text(k % 28 + 1), F.lit(" */2 "), text(k % 7)))
             .when(form == 8, F.concat(at, F.lit("29 2 *")))
             .when(k % 20 == 9, F.concat(at, F.lit("* * MON")))
             .otherwise(F.concat(text(k % 60 + 60), F.lit(" 9 * * *"))))
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("c_nationkey") % len(ZONES) + 1).cast("int"))
    looked = F.lit("2024-03-08 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=(k * 7 % 250).cast("int"), hours=(k % 24).cast("int"),
                                                                                    mins=(k * 13 % 60).cast("int"))
    return table(spark, sf, "customer").select(text(k).alias("name"), cron.alias("cron"), zone.alias("timezone"), F.lower("c_mktsegment").alias("type"),
                                               looked.alias("last_run_at"))
