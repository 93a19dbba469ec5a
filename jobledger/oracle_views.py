"""The ledger fixtures as portable SQL for the DuckDB oracle.

Same definitions as ``jobledger.sources.fixtures`` (which builds them with the
DataFrame API). ``with_views`` prefixes an oracle query with the CTEs it needs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "attempts": """
SELECT l_orderkey AS job_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INT) AS attempt,
       l_shipdate AS started_at,
       CAST(floor(l_quantity) AS BIGINT) * 1000 AS duration_ms,
       CASE l_returnflag WHEN 'N' THEN 'completed' ELSE 'failed' END AS outcome,
       CASE l_returnflag WHEN 'R' THEN 'backend_error' WHEN 'A' THEN 'invalid_payload' END AS error_code,
       l_returnflag = 'R' AS retryable,
       concat('worker_host_a_', CAST(l_suppkey AS VARCHAR), '_1') AS worker_id
FROM lineitem""",
    "jobs": """
SELECT o.o_orderkey AS job_id,
       concat('order.', lower(substr(o.o_orderpriority, 3))) AS type,
       lower(c.c_mktsegment) AS queue,
       5 - CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS priority,
       coalesce(a.n, 0) AS attempt,
       3 AS max_attempts,
       CASE WHEN o.o_orderstatus = 'O' THEN 'available'
            WHEN o.o_orderstatus = 'P' THEN 'active'
            WHEN a.n IS NULL THEN 'scheduled'
            WHEN a.last_outcome = 'completed' THEN 'completed'
            WHEN a.last_retryable AND a.n < 3 THEN 'retryable'
            ELSE 'discarded' END AS state,
       o.o_orderdate AS created_at,
       a.first_started AS started_at
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (
  SELECT job_id, CAST(count(*) AS INT) AS n,
         max(CASE WHEN rn = 1 THEN outcome END) AS last_outcome,
         bool_or(rn = 1 AND retryable) AS last_retryable,
         min(started_at) AS first_started
  FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY attempt DESC) AS rn FROM attempts) t
  GROUP BY job_id) a ON a.job_id = o.o_orderkey""",
    "job_events": """
SELECT event_id,
       CASE event_type WHEN 'signup' THEN 'job.enqueued' WHEN 'view' THEN 'job.started' WHEN 'click' THEN 'job.progress'
                       WHEN 'purchase' THEN 'job.completed' ELSE 'job.failed' END AS type,
       CAST(user_id AS VARCHAR) AS subject, ts AS time, value, props AS data
FROM events""",
    "requests": """
SELECT event_id AS request_id, CAST(floor(event_id / 10) AS BIGINT) AS batch_id, event_id % 10 AS seq,
       concat(CASE WHEN event_id % 50 = 0 THEN 'Bad ' ELSE '' END, 'evt.', event_type) AS type,
       CASE WHEN event_id % 97 = 0 THEN 'BadQueue' WHEN user_id % 7 = 0 THEN '' ELSE concat('q', CAST(user_id % 5 AS VARCHAR)) END AS queue,
       concat('[', props, ']') AS args, ts AS created_at,
       concat(CAST(user_id AS VARCHAR), '|', event_type) AS unique_key,
       CAST(floor(value * 1000) AS BIGINT) AS delay_ms
FROM events""",
    "meta_patches": """
SELECT user_id AS job_id, event_id AS seq, event_type AS meta_key, props AS meta_value FROM events""",
    "directives": """
SELECT user_id AS worker, event_id, ts,
       CASE WHEN event_type = 'view' THEN 'running' WHEN event_type = 'click' THEN 'quiet'
            WHEN event_type = 'error' AND value > 100 THEN 'terminate' ELSE 'noop' END AS desired
FROM events""",
    "polls": """
SELECT user_id AS worker, event_id, ts, event_type IN ('error', 'click') AS failed FROM events""",
    "heartbeats": """
SELECT concat('worker_host_a_', CAST(user_id % 8 AS VARCHAR), '_1') AS worker_id, ts, event_id, user_id AS active_job_id FROM events""",
    "workflow_steps": """
SELECT job_id AS workflow_id, concat('job-', CAST(attempt - 1 AS VARCHAR)) AS step_id,
       CASE WHEN attempt > 1 THEN concat('job-', CAST(attempt - 2 AS VARCHAR)) END AS depends_on_id,
       CASE WHEN outcome = 'completed' THEN 'completed' WHEN retryable THEN 'active' ELSE 'discarded' END AS state
FROM attempts""",
    "batch_steps": """
SELECT workflow_id, step_id, state, depends_on_id FROM workflow_steps
UNION ALL
SELECT c.workflow_id, c.step_id, c.state, d.step_id AS depends_on_id
FROM (SELECT DISTINCT workflow_id, 'on-complete' AS step_id, CASE WHEN workflow_id % 4 = 0 THEN 'completed' ELSE 'pending' END AS state
      FROM workflow_steps WHERE workflow_id % 2 = 0
      UNION ALL SELECT DISTINCT workflow_id, 'on-success', CASE WHEN workflow_id % 9 <> 0 THEN 'completed' ELSE 'pending' END
      FROM workflow_steps WHERE workflow_id % 3 = 0
      UNION ALL SELECT DISTINCT workflow_id, 'on-failure', CASE WHEN workflow_id % 7 = 0 THEN 'completed' ELSE 'pending' END
      FROM workflow_steps WHERE workflow_id % 5 <> 0) c
JOIN workflow_steps d ON c.workflow_id = d.workflow_id""",
    "api_responses": """
SELECT event_id, ts,
       CASE event_type WHEN 'error' THEN 429 WHEN 'click' THEN 404 WHEN 'purchase' THEN 409 WHEN 'view' THEN 500 ELSE 200 END AS status,
       CASE event_type WHEN 'error' THEN 'rate_limited' WHEN 'click' THEN 'not_found' WHEN 'purchase' THEN 'other' WHEN 'view' THEN 'backend_error' END AS code,
       event_type IN ('error', 'view') AS retryable, value, props
FROM events""",
    "messages": """
SELECT CAST(floor(event_id / 10) AS BIGINT) AS batch_id, concat('msg-', CAST(event_id AS VARCHAR)) AS message_id,
       CASE WHEN event_id % 31 = 0 THEN '{bad'
            ELSE concat('{"id":"', CAST(event_id AS VARCHAR), '","type":"evt.', event_type, '","args":[', props, ']}') END AS body
FROM events""",
    "handlers": """
SELECT 'order.urgent' AS type UNION ALL SELECT 'order.high' UNION ALL SELECT 'order.low'""",
    "queues": """
SELECT 'automobile' AS queue, 'active' AS status, 0 AS ord UNION ALL SELECT 'building', 'paused', 1
UNION ALL SELECT 'furniture', 'active', 2 UNION ALL SELECT 'household', NULL, 3 UNION ALL SELECT 'machinery', 'paused', 4
UNION ALL SELECT 'idle', 'active', 5 UNION ALL SELECT 'parked', 'paused', 6""",
    "cron_jobs": """
SELECT 'daily-report' AS name, '0 9 * * *' AS cron, 'UTC' AS timezone, 'report.generate' AS type
UNION ALL SELECT 'nightly-cleanup', '0 2 * * *', 'UTC', 'cleanup.run'
UNION ALL SELECT 'weekly-digest', '30 6 * * 1', 'UTC', 'digest.send'
UNION ALL SELECT 'monthly-invoice', '0 0 1 * *', 'UTC', 'invoice.run'
UNION ALL SELECT 'odd-days', '*/20 8-9 */2 * *', 'UTC', 'probe.run'
UNION ALL SELECT 'friday-or-13th', '15 12 13 * 5', 'UTC', 'luck.check'
UNION ALL SELECT 'leap-day', '0 0 29 2 *', 'UTC', 'leap.run'
UNION ALL SELECT 'never', '0 0 31 2 *', 'UTC', 'never.run'
UNION ALL SELECT 'broken', '0 9 * * MON', 'UTC', 'broken.run'""",
    "schedules": """
SELECT CAST(c_custkey AS VARCHAR) AS name, c_custkey AS k, c_custkey % 10 AS form, c_nationkey % 4 AS zone, lower(c_mktsegment) AS type,
       CASE WHEN c_custkey % 10 < 3 THEN (c_custkey % 60) || ' ' || (c_custkey % 24) || ' * * *'
            WHEN c_custkey % 10 < 6 THEN (c_custkey % 60) || ' ' || (c_custkey % 24) || ' * * ' || (c_custkey % 8)
            WHEN c_custkey % 10 = 6 THEN (c_custkey % 60) || ' ' || (c_custkey % 24) || ' ' || (c_custkey % 31 + 1) || ' * *'
            WHEN c_custkey % 10 = 7 THEN '*/20 1-3 ' || (c_custkey % 28 + 1) || ' */2 ' || (c_custkey % 7)
            WHEN c_custkey % 10 = 8 THEN (c_custkey % 60) || ' ' || (c_custkey % 24) || ' 29 2 *'
            WHEN c_custkey % 20 = 9 THEN (c_custkey % 60) || ' ' || (c_custkey % 24) || ' * * MON'
            ELSE (c_custkey % 60 + 60) || ' 9 * * *' END AS cron,
       TIMESTAMP '2024-03-08' + to_days(CAST(c_custkey * 7 % 250 AS INT)) + to_hours(c_custkey % 24) + to_minutes(c_custkey * 13 % 60) AS last_run_at
FROM customer""",
}

DEPENDS = {"jobs": ["attempts"], "workflow_steps": ["attempts"], "batch_steps": ["workflow_steps"]}


def with_views(names: list[str], body: str) -> str:
    """``WITH <needed views> <body>``; dependencies come first, each once."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"
