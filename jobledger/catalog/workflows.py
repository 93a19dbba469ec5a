"""Queries for workflow expansion and rollups (G1, A7-A9) and cron."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobledger.catalog.registry import register
from jobledger.operators import schedules as C
from jobledger.operators import workflows as WF
from jobledger.plans.strategy import dealt, parts_for
from jobledger.sources import fixtures as fx
from jobledger.sources.tables import table


LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")


def _definitions(spark, sf):
    """One workflow definition per order; its steps are the order's line items,
    which give all nine options now and then."""
    li = table(spark, sf, "lineitem")
    line = F.col("l_linenumber")
    step = F.struct(
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        F.concat(F.lit("line."), F.lower("l_linestatus")).alias("type"),
        F.concat(F.lit('{"qty":'), F.floor("l_quantity").cast("bigint").cast("string"), F.lit("}")).alias("args"),
        F.when(F.col("l_returnflag") == "R", "returns").when(F.col("l_returnflag") == "N", "default").alias("queue"),
        F.when(F.col("l_quantity") > 40, F.lit(30000)).otherwise(F.lit(0)).cast("bigint").alias("timeout_ms"),
        (line % 3).cast("int").alias("priority"),
        F.when(F.col("l_suppkey") % 5 == 0, F.lit(45_000_500)).cast("bigint").alias("visibility_timeout_us"),
        F.when(line == 2, F.col("l_shipdate")).alias("delay_until"),
        F.when(line == 3, F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("expires_at"),
        F.when(F.col("l_partkey") % 4 == 0, F.struct(
            line.cast("int").alias("max_attempts"), F.lit(2_000_000).cast("bigint").alias("initial_interval_us"),
            F.lit(1.5).alias("backoff_coefficient"), F.lit(None).cast("bigint").alias("max_interval_us"),
            (line % 2 == 0).alias("jitter"),
            F.when(line == 1, F.array(F.lit("invalid_"))).alias("non_retryable_errors"))).alias("retry"),
        F.when(F.col("l_partkey") % 7 == 0, F.struct(
            F.array(F.lit("type")).alias("key"), F.lit(3_600_000_000).cast("bigint").alias("period_us"),
            F.lit("ignore").alias("on_conflict"))).alias("unique"),
        F.when(F.col("l_linestatus") == "O", F.array(F.lit("open"), F.concat(F.lit("line-"), line.cast("string")))).alias("tags"))
    # dealt while they are narrow: a step is many times wider than its line
    li = dealt(li.select(*LINE), parts_for(li), "l_orderkey")
    # steps in line order; the leading sort fields stay in the struct (the
    # expansion reads steps by field name)
    steps = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    o = table(spark, sf, "orders")
    d = F.substring("o_orderpriority", 1, 1)
    kind = (F.when(d == "1", "chain").when(d == "2", "group").when(d.isin("3", "4"), "batch").otherwise("saga"))
    cb = F.struct(
        F.struct(F.lit("batch.done").alias("type"), F.lit("{}").alias("args")).alias("on_complete"),
        F.when(F.col("o_totalprice") > 100000, F.struct(
            F.lit("batch.ok").alias("type"),
            F.concat(F.lit('{"total":'), F.floor("o_totalprice").cast("bigint").cast("string"), F.lit("}")).alias("args")))
        .alias("on_success"),
        F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("batch.failed").alias("type"), F.lit("{}").alias("args")))
        .alias("on_failure"))
    options = F.when(F.col("o_custkey") % 3 != 0, F.struct(
        F.when(F.col("o_orderstatus") == "F", "bulk").when(F.col("o_orderstatus") == "P", "").alias("queue"),
        F.when(F.col("o_totalprice") > 200000, 1_500_999).cast("bigint").alias("timeout_us"),
        (F.col("o_custkey") % 4).cast("int").alias("priority"), F.array(F.lower("o_orderstatus")).alias("tags")))
    return o.join(steps, o.o_orderkey == steps.l_orderkey, "left").select(
        F.col("o_orderkey").alias("workflow_id"), F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name"),
        kind.alias("kind"), "steps", cb.alias("callbacks"), options.alias("options"))


def _rfc3339_sql(t: str) -> str:
    return (f"""strftime({t}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({t}) % 1000000 = 0 THEN '' """
            f"""ELSE '.' || rtrim(printf('%06d', epoch_us({t}) % 1000000), '0') END || 'Z'""")


STEP_OPTIONS_SQL = f"""'{{"queue":"' || coalesce(queue, 'default') || '"' ||
  CASE WHEN line % 3 <> 0 THEN ',"priority":' || CAST(line % 3 AS VARCHAR) ELSE '' END ||
  CASE WHEN timeout_ms <> 0 THEN ',"timeout_ms":' || CAST(timeout_ms AS VARCHAR) ELSE '' END ||
  CASE WHEN line = 2 THEN ',"delay_until":"' || {_rfc3339_sql("ship")} || '"' ELSE '' END ||
  CASE WHEN line = 3 THEN ',"expires_at":"' || {_rfc3339_sql("(ship + INTERVAL 1 DAY)")} || '"' ELSE '' END ||
  CASE WHEN part % 4 = 0 THEN ',"retry":{{' || CASE WHEN line <> 0 THEN '"max_attempts":' || CAST(line AS VARCHAR) || ',' ELSE '' END ||
       '"initial_interval_ms":2000,"backoff_coefficient":1.5,"jitter":' || CASE WHEN line % 2 = 0 THEN 'true' ELSE 'false' END ||
       CASE WHEN line = 1 THEN ',"non_retryable_errors":["invalid_"]' ELSE '' END || '}}' ELSE '' END ||
  CASE WHEN part % 7 = 0 THEN ',"unique":{{"key":["type"],"period_ms":3600000,"on_conflict":"ignore"}}' ELSE '' END ||
  CASE WHEN status = 'O' THEN ',"tags":["open","line-' || CAST(line AS VARCHAR) || '"]' ELSE '' END ||
  CASE WHEN supp % 5 = 0 THEN ',"visibility_timeout_ms":45000' ELSE '' END || '}}'"""


@register("expand_workflows", sql=f"""
WITH li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos,
         'line.' || lower(l_linestatus) AS type,
         '{{"qty":' || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '}}' AS args,
         CASE l_returnflag WHEN 'R' THEN 'returns' WHEN 'N' THEN 'default' END AS queue,
         CASE WHEN l_quantity > 40 THEN 30000 ELSE 0 END AS timeout_ms,
         l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, l_linestatus AS status, l_shipdate AS ship
  FROM lineitem),
n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
d AS (SELECT o_orderkey AS workflow_id,
             CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'chain' WHEN '2' THEN 'group' WHEN '3' THEN 'batch' WHEN '4' THEN 'batch' ELSE 'saga' END AS kind,
             o_totalprice, o_orderstatus FROM orders),
main AS (
  SELECT d.workflow_id, CASE WHEN kind = 'chain' THEN 'step-' ELSE 'job-' END || CAST(li.pos AS VARCHAR) AS step_id,
         li.type, '[' || li.args || ']' AS args,
         CASE WHEN kind = 'chain' AND li.pos > 0 THEN 'step-' || CAST(li.pos - 1 AS VARCHAR) ELSE '' END AS depends_on,
         CASE WHEN kind = 'chain' AND (coalesce(queue, 'default') <> 'default' OR timeout_ms > 0) THEN {STEP_OPTIONS_SQL} END AS options
  FROM d JOIN li ON d.workflow_id = li.l_orderkey WHERE kind IN ('chain', 'group', 'batch')),
b AS (SELECT d.*, coalesce(n.n, 0) AS n,
             coalesce(array_to_string(list_transform(range(CAST(coalesce(n.n, 0) AS BIGINT)), lambda i: 'job-' || CAST(i AS VARCHAR)), ','), '') AS deps
      FROM d LEFT JOIN n ON d.workflow_id = n.l_orderkey WHERE kind = 'batch'),
cb AS (
  SELECT workflow_id, 'on-complete' AS step_id, 'batch.done' AS type, '[]' AS args, deps AS depends_on, CAST(NULL AS VARCHAR) AS options FROM b
  UNION ALL SELECT workflow_id, 'on-success', 'batch.ok', '[{{"total":' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '}}]', deps, NULL FROM b WHERE o_totalprice > 100000
  UNION ALL SELECT workflow_id, 'on-failure', 'batch.failed', '[]', deps, NULL FROM b WHERE o_orderstatus = 'F')
SELECT * FROM main UNION ALL SELECT * FROM cb""")
def q_expand_workflows(spark, sf):
    steps = WF.expand_workflows(_definitions(spark, sf))
    return steps.select("workflow_id", "step_id", "type", "args", F.array_join("depends_on", ",").alias("depends_on"),
                        "options")


@register("workflow_requests", sql="""
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
d AS (SELECT o_orderkey AS workflow_id, 'order-' || CAST(o_orderkey AS VARCHAR) AS name,
             CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'chain' WHEN '2' THEN 'group' WHEN '3' THEN 'batch' WHEN '4' THEN 'batch' ELSE 'saga' END AS kind,
             o_custkey AS cust, o_totalprice AS price, o_orderstatus AS status, coalesce(n.n, 0) AS n
      FROM orders LEFT JOIN n ON o_orderkey = l_orderkey)
SELECT workflow_id, name, kind,
       CAST(CASE kind WHEN 'saga' THEN 0 WHEN 'batch' THEN n + 1 + CASE WHEN price > 100000 THEN 1 ELSE 0 END + CASE WHEN status = 'F' THEN 1 ELSE 0 END ELSE n END AS INT) AS n_steps,
       CASE WHEN cust % 3 <> 0 AND (status IN ('F', 'P') OR price > 200000) THEN
         '{' || concat_ws(',', CASE status WHEN 'F' THEN '"queue":"bulk"' WHEN 'P' THEN NULL ELSE '"queue":"default"' END,
           CASE WHEN cust % 4 <> 0 THEN '"priority":' || CAST(cust % 4 AS VARCHAR) END,
           CASE WHEN price > 200000 THEN '"timeout_ms":1500' END, '"tags":["' || lower(status) || '"]') || '}' END AS options
FROM d""")
def q_workflow_requests(spark, sf):
    return WF.workflow_requests(_definitions(spark, sf))


@register("workflow_state", views=("batch_steps",), sql="""
, st AS (SELECT DISTINCT workflow_id, step_id, state FROM batch_steps)
, g AS (SELECT workflow_id, count(*) AS steps,
               count_if(step_id NOT IN ('on-complete', 'on-success', 'on-failure') AND state = 'discarded') AS n_failed,
               count_if(state = 'completed') AS n_completed, count_if(state <> 'pending') AS n_started,
               count_if(step_id <> 'on-failure' AND state <> 'completed') AS n_open
        FROM st GROUP BY workflow_id)
, c AS (SELECT DISTINCT o_orderkey AS workflow_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
SELECT g.workflow_id,
       CASE WHEN c.workflow_id IS NOT NULL THEN 'cancelled' WHEN n_failed > 0 THEN 'failed'
            WHEN n_open = 0 THEN 'completed' WHEN n_started > 0 THEN 'running' ELSE 'pending' END AS state,
       steps, CAST(n_completed AS BIGINT) AS n_completed, CAST(n_failed AS BIGINT) AS n_failed
FROM g LEFT JOIN c ON g.workflow_id = c.workflow_id""")
def q_workflow_state(spark, sf):
    o = table(spark, sf, "orders")
    cancelled = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")).select(
        F.col("o_orderkey").alias("workflow_id"))
    return WF.workflow_state(fx.batch_steps(spark, sf), cancelled)


@register("batch_callbacks", views=("batch_steps",), sql="""
, st AS (SELECT DISTINCT workflow_id, step_id, state FROM batch_steps)
, g AS (SELECT workflow_id,
               count_if(step_id NOT IN ('on-complete', 'on-success', 'on-failure')) AS n,
               count_if(step_id NOT IN ('on-complete', 'on-success', 'on-failure') AND state IN ('completed', 'cancelled', 'discarded')) AS n_term,
               count_if(step_id NOT IN ('on-complete', 'on-success', 'on-failure') AND state = 'completed') AS n_done,
               count_if(step_id NOT IN ('on-complete', 'on-success', 'on-failure') AND state IN ('discarded', 'cancelled')) AS n_bad
        FROM st GROUP BY workflow_id)
SELECT s.workflow_id, s.step_id AS callback FROM st s JOIN g ON s.workflow_id = g.workflow_id
WHERE (s.step_id = 'on-complete' AND n_term = n) OR (s.step_id = 'on-success' AND n_done = n)
   OR (s.step_id = 'on-failure' AND n_term = n AND n_bad > 0)""")
def q_batch_callbacks(spark, sf):
    return WF.batch_callbacks(fx.batch_steps(spark, sf))


@register("cancel_workflows", views=("workflow_steps",), sql="""
, ids AS (SELECT DISTINCT o_orderkey AS workflow_id FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT s.workflow_id,
       CAST(count_if(s.state NOT IN ('completed', 'cancelled', 'discarded')) AS BIGINT) AS steps_cancelled,
       CAST(count_if(s.state = 'completed') AS BIGINT) AS steps_already_completed, 'cancelled' AS state
FROM workflow_steps s JOIN ids ON s.workflow_id = ids.workflow_id GROUP BY s.workflow_id""")
def q_cancel_workflows(spark, sf):
    o = table(spark, sf, "orders")
    ids = o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("workflow_id"))
    summary, _ = WF.cancel_workflows(fx.workflow_steps(spark, sf), ids)
    return summary


def _event_range(spark, sf):
    """[midnight of the first event, last event): two scalars from one aggregate."""
    r = table(spark, sf, "events").agg(F.date_trunc("day", F.min("ts")).alias("s"), F.max("ts").alias("e")).first()
    return r["s"], r["e"]


# each schedule's times of day, and its days, said in SQL
CRON_SQL = """
, times(name, h, m) AS (VALUES ('daily-report', 9, 0), ('nightly-cleanup', 2, 0), ('weekly-digest', 6, 30), ('monthly-invoice', 0, 0),
    ('odd-days', 8, 0), ('odd-days', 8, 20), ('odd-days', 8, 40), ('odd-days', 9, 0), ('odd-days', 9, 20), ('odd-days', 9, 40),
    ('friday-or-13th', 12, 15), ('leap-day', 0, 0))
, days AS (SELECT unnest(generate_series(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP), max(ts) + INTERVAL 9 YEAR, INTERVAL 1 DAY)) AS d FROM events)
, runs AS (
  SELECT c.name, c.type, d + to_hours(h) + to_minutes(m) AS run_at
  FROM cron_jobs c JOIN times ON c.name = times.name, days
  WHERE CASE c.name WHEN 'weekly-digest' THEN dayofweek(d) = 1 WHEN 'monthly-invoice' THEN day(d) = 1 WHEN 'odd-days' THEN day(d) % 2 = 1
                    WHEN 'friday-or-13th' THEN day(d) = 13 OR dayofweek(d) = 5 WHEN 'leap-day' THEN month(d) = 2 AND day(d) = 29 ELSE true END)"""
CRON_RANGE_SQL = CRON_SQL + """
, r AS (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS s, max(ts) AS e FROM events)
, expected AS (SELECT runs.* FROM runs, r WHERE run_at >= r.s AND run_at < r.e)"""


@register("expand_cron", views=("cron_jobs",), sql=CRON_RANGE_SQL + "\nSELECT name, type, run_at FROM expected")
def q_expand_cron(spark, sf):
    s, e = _event_range(spark, sf)
    return C.expand_cron(fx.cron_jobs(spark), s, e)


@register("cron_audit", views=("cron_jobs",), sql=CRON_RANGE_SQL + """
, trg AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'daily-report' ELSE 'nightly-cleanup' END AS name, ts AS time
          FROM events WHERE event_type = 'signup')
SELECT e.name, e.run_at, CASE WHEN count(t.time) > 0 THEN 'triggered' ELSE 'skipped' END AS status, count(t.time) AS n_triggers
FROM expected e LEFT JOIN trg t ON t.name = e.name AND t.time >= e.run_at AND t.time < e.run_at + INTERVAL 6 HOUR
GROUP BY e.name, e.run_at""")
def q_cron_audit(spark, sf):
    s, e = _event_range(spark, sf)
    expected = C.expand_cron(fx.cron_jobs(spark), s, e)
    ev = table(spark, sf, "events").filter(F.col("event_type") == "signup")
    triggers = ev.select(F.when(F.col("user_id") % 2 == 0, "daily-report").otherwise("nightly-cleanup").alias("name"),
                         F.col("ts").alias("time"))
    return C.cron_audit(expected, triggers, grace_seconds=6 * 3600)


@register("next_runs", views=("cron_jobs",), sql=CRON_SQL + """
SELECT name, min(run_at) AS next_run_at FROM runs, (SELECT max(ts) AS as_of FROM events) WHERE run_at >= as_of GROUP BY name""")
def q_next_runs(spark, sf):
    as_of = table(spark, sf, "events").agg(F.max("ts").alias("m")).first()["m"]
    return C.next_runs(fx.cron_jobs(spark), as_of)


# a schedule's local times (per day and time of day), read in UTC: winter time
# and summer time between the last Sundays of March and October (Europe) or the
# second of March and the first of November (America), where the reading holds
ZONED_SQL = """
, sundays AS (SELECT y, make_date(y, 3, 31) - CAST(dayofweek(make_date(y, 3, 31)) AS INT) AS eu1, make_date(y, 10, 31) - CAST(dayofweek(make_date(y, 10, 31)) AS INT) AS eu2,
                     make_date(y, 3, 14) - CAST(dayofweek(make_date(y, 3, 14)) AS INT) AS us1, make_date(y, 11, 7) - CAST(dayofweek(make_date(y, 11, 7)) AS INT) AS us2
              FROM (SELECT unnest(range(2023, 2035)) AS y))
, days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-03-06', TIMESTAMP '2029-03-10', INTERVAL 1 DAY)) AS TIMESTAMP) AS d)
, times AS (SELECT unnest(range(1, 4)) AS h, 0 AS m UNION ALL SELECT unnest(range(1, 4)), 20 UNION ALL SELECT unnest(range(1, 4)), 40)
, local AS (
  SELECT name, type, zone, last_run_at, d + to_hours(k % 24) + to_minutes(k % 60) AS l FROM schedules, days
  WHERE CASE WHEN form < 3 THEN true WHEN form < 6 THEN dayofweek(d) = k % 8 % 7 WHEN form = 6 THEN day(d) = k % 31 + 1
             WHEN form = 8 THEN month(d) = 2 AND day(d) = 29 ELSE false END
    AND (form = 8 OR d < last_run_at + INTERVAL 70 DAY) AND d > last_run_at - INTERVAL 3 DAY
  UNION ALL
  SELECT name, type, zone, last_run_at, d + to_hours(h) + to_minutes(m) FROM schedules, days, times
  WHERE form = 7 AND month(d) % 2 = 1 AND (day(d) = k % 28 + 1 OR dayofweek(d) = k % 7)
    AND d < last_run_at + INTERVAL 70 DAY AND d > last_run_at - INTERVAL 3 DAY)
, readings AS (
  SELECT DISTINCT name, type, last_run_at, zone, summer, l - to_hours(CAST(CASE zone WHEN 1 THEN -5 WHEN 2 THEN 1 ELSE 0 END + summer AS INT)) AS u
  FROM local, (SELECT unnest([0, 1]) AS summer))
, runs AS (
  SELECT name, type, last_run_at, u AS run_at FROM readings JOIN sundays ON y = year(u)
  WHERE summer = CASE zone WHEN 1 THEN CASE WHEN u >= us1 + INTERVAL 7 HOUR AND u < us2 + INTERVAL 6 HOUR THEN 1 ELSE 0 END
                           WHEN 2 THEN CASE WHEN u >= eu1 + INTERVAL 1 HOUR AND u < eu2 + INTERVAL 1 HOUR THEN 1 ELSE 0 END ELSE 0 END)"""


@register("next_runs_zoned", views=("schedules",), sql=ZONED_SQL + """
SELECT name, min(run_at) AS next_run_at FROM runs WHERE run_at >= last_run_at GROUP BY name""")
def q_next_runs_zoned(spark, sf):
    """The next run of every customer's schedule, in its zone, after its own
    last look; both clock changes lie in the span."""
    return C.next_runs(fx.schedules(spark, sf), F.col("last_run_at"))


@register("expand_cron_zoned", views=("schedules",), sql=ZONED_SQL.replace("last_run_at", "looked_at").replace(
    "FROM schedules", "FROM (SELECT * EXCLUDE (last_run_at), TIMESTAMP '2024-10-26' AS looked_at FROM schedules) s") + """
SELECT name, type, run_at FROM runs WHERE run_at >= TIMESTAMP '2024-10-26' AND run_at < TIMESTAMP '2024-11-05'""")
def q_expand_cron_zoned(spark, sf):
    """All runs over the days on which both zones go back to winter time."""
    return C.expand_cron(fx.schedules(spark, sf), "2024-10-26 00:00:00", "2024-11-05 00:00:00")


@register("cron_errors", views=("schedules",), sql="""
SELECT name, cron, CASE WHEN k % 20 = 9 THEN 'invalid dow field MON' ELSE 'invalid minute field ' || (k % 60 + 60) END AS cron_error
FROM schedules WHERE form = 9""")
def q_cron_errors(spark, sf):
    return C.cron_errors(fx.schedules(spark, sf)).select("name", "cron", "cron_error")
