"""Explicit schemas for wire envelopes (never inferred)."""

from __future__ import annotations

# Job envelope on the wire. args/meta/result stay raw JSON text (the JSON
# reader keeps nested values of STRING fields as their JSON text); they are
# decoded on demand (args -> MAP<STRING,VARIANT>, meta/result -> VARIANT).
JOB_WIRE = """
id STRING, type STRING, state STRING, queue STRING, priority INT, attempt INT, max_attempts INT,
timeout_ms BIGINT, tags ARRAY<STRING>, meta STRING, result STRING,
error STRUCT<code: STRING, message: STRING, retryable: BOOLEAN, details: STRING>,
created_at TIMESTAMP, enqueued_at TIMESTAMP, started_at TIMESTAMP, completed_at TIMESTAMP,
cancelled_at TIMESTAMP, discarded_at TIMESTAMP, scheduled_at TIMESTAMP, expires_at TIMESTAMP,
args STRING, previous_state STRING
"""

JOB_TIMESTAMPS = ["created_at", "enqueued_at", "started_at", "completed_at",
                  "cancelled_at", "discarded_at", "scheduled_at", "expires_at"]

# Job event inside a queue message or push delivery.
JOB_EVENT = "id STRING, type STRING, queue STRING, args STRING, attempt INT, meta STRING, priority INT"

PUSH_DELIVERY = f"job STRUCT<{JOB_EVENT.replace(' STRING', ': STRING').replace(' INT', ': INT')}>, worker_id STRING, delivery_id STRING"

EVENT = "type STRING, source STRING, subject STRING, time TIMESTAMP, data STRING"
