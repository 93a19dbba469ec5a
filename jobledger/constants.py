"""Fixed values of the job protocol.

FIXED VALUES: these must equal the protocol's own values for results to agree
(states, patterns, limits, defaults, event names, error codes). They are listed
plainly, in the protocol's natural order.
"""

# --- fixed values: job states -------------------------------------------------
JOB_STATES = ["pending", "scheduled", "available", "active",
              "completed", "retryable", "cancelled", "discarded"]
TERMINAL_STATES = ["completed", "cancelled", "discarded"]

# --- fixed values: validation -------------------------------------------------
# Written with \z instead of $: in Java regex `$` also matches before a final
# newline, which would accept "default\n".
TYPE_PATTERN = r"^[a-z][a-z0-9_\-]*(\.[a-z][a-z0-9_\-]*)*\z"
QUEUE_PATTERN = r"^[a-z0-9][a-z0-9\-\.]*\z"
# pattern text as shown in the validation message
TYPE_PATTERN_TEXT = r"^[a-z][a-z0-9_-]*(\.[a-z][a-z0-9_-]*)*$"
QUEUE_PATTERN_TEXT = r"^[a-z0-9][a-z0-9\-\.]*$"
MAX_TYPE_BYTES = 255
MAX_QUEUE_BYTES = 128
DEFAULT_QUEUE = "default"

# --- fixed values: retry policy defaults ---------------------------------------
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_INITIAL_INTERVAL_MS = 1000
DEFAULT_BACKOFF_COEFFICIENT = 2.0
DEFAULT_MAX_INTERVAL_MS = 5 * 60 * 1000
DEFAULT_JITTER = True

# --- fixed values: worker ------------------------------------------------------
WORKER_STATES = ["running", "quiet", "terminate"]
MAX_FETCH_BACKOFF_MS = 30_000
MAX_FETCH_SHIFT = 10
DEFAULT_CONCURRENCY = 10
MAX_RESPONSE_BYTES = 10 * 1024 * 1024

# --- fixed values: error codes -------------------------------------------------
ERR_HANDLER_ERROR = "handler_error"
ERR_TIMEOUT = "timeout"
ERR_CANCELLED = "cancelled"
ERR_INVALID_PAYLOAD = "invalid_payload"
ERR_INVALID_REQUEST = "invalid_request"
ERR_NOT_FOUND = "not_found"
ERR_BACKEND_ERROR = "backend_error"
ERR_RATE_LIMITED = "rate_limited"
ERR_DUPLICATE = "duplicate"
ERR_QUEUE_PAUSED = "queue_paused"
ERR_SCHEMA_VALIDATION = "schema_validation"
ERR_UNSUPPORTED = "unsupported"
# code -> sentinel class, checked in this order; HTTP 409 is the fallback "conflict"
ERROR_CLASSES = [
    ("not_found", "not_found"),
    ("duplicate", "duplicate"),
    ("queue_paused", "queue_paused"),
    ("rate_limited", "rate_limited"),
    ("backend_error", "backend"),
    ("timeout", "timeout"),
]
CONFLICT_STATUS = 409
CONFLICT_CLASS = "conflict"

# --- fixed values: event types -------------------------------------------------
JOB_EVENTS = ["job.enqueued", "job.started", "job.completed", "job.failed", "job.discarded",
              "job.retrying", "job.cancelled", "job.scheduled", "job.expired", "job.progress"]
WORKER_EVENTS = ["worker.started", "worker.stopped", "worker.quiet", "worker.heartbeat"]
WORKFLOW_EVENTS = ["workflow.started", "workflow.step_completed",
                   "workflow.completed", "workflow.failed"]
CRON_EVENTS = ["cron.triggered", "cron.skipped"]
QUEUE_EVENTS = ["queue.paused", "queue.resumed"]

# Event type -> job state it leaves the job in (ours; progress keeps the state).
EVENT_STATE = {
    "job.enqueued": "available",
    "job.scheduled": "scheduled",
    "job.started": "active",
    "job.completed": "completed",
    "job.failed": "retryable",
    "job.retrying": "retryable",
    "job.cancelled": "cancelled",
    "job.discarded": "discarded",
    "job.expired": "discarded",
}

# --- fixed values: workflows ---------------------------------------------------
WORKFLOW_STATES = ["pending", "running", "completed", "failed", "cancelled"]
CALLBACK_STEPS = ["on-complete", "on-success", "on-failure"]

# --- histogram bucket upper edges in ms (ours) ---------------------------------
DURATION_BUCKETS_MS = [0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000]

# --- span / log naming (ours: a neutral namespace, overridable per call) ------
SPAN_PREFIX = "job "
SPAN_SYSTEM = "jobs"
