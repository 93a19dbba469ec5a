"""P13-P15, S6 and A13 cases."""

import pytest

from jobledger.operators import aggregations as AG
from jobledger.operators import projections as P
from jobledger.sources.responses import parse_error_responses


@pytest.mark.parametrize("code,status,cls", [
    ("not_found", 404, "not_found"), ("duplicate", 409, "duplicate"), ("queue_paused", 422, "queue_paused"),
    ("rate_limited", 429, "rate_limited"), ("backend_error", 500, "backend"), ("timeout", 504, "timeout"),
    ("other", 409, "conflict"), ("other", 400, None),
])
def test_error_classes(spark, code, status, cls):
    df = spark.createDataFrame([(code, status)], "code string, status int")
    assert P.classify_errors(df).first().error_class == cls


def test_retryability_defaults_differ(spark):
    df = spark.createDataFrame([("api", True), ("api", False), ("marked", True), ("other", None), (None, None)],
                               "error_kind string, retryable boolean")
    api = [r.is_retryable for r in P.api_retryable(df).collect()]
    handler = [r.is_retryable for r in P.handler_retryable(df).collect()]
    assert api == [True, False, False, False, None]
    assert handler == [True, True, False, True, None]


def responses(spark, rows):
    return spark.createDataFrame(rows, "status int, body string, headers map<string,string>")


def test_parse_error_response_fields(spark):
    body = '{"error":{"code":"rate_limited","message":"slow down","retryable":true,"request_id":"r1"}}'
    rows = [(429, body, {"Retry-After": "60"}),
            (429, body, {}),
            (429, body, {"retry-after": "30", "X-RateLimit-Limit": "100", "X-RateLimit-Remaining": "0",
                         "X-RateLimit-Reset": "1700000000"}),
            (502, "<html>bad gateway</html>", {"Retry-After": "5"}),
            (200, "{}", {})]
    out = parse_error_responses(responses(spark, rows)).collect()
    assert len(out) == 4
    a, b, c, d = out
    assert (a.code, a.message, a.retryable, a.request_id, a.retry_after_ms) == ("rate_limited", "slow down", True, "r1", 60000.0)
    assert a.rl_limit == 0 and a.rl_remaining == 0
    assert b.retry_after_ms == 0.0 and b.rl_limit is None
    assert (c.retry_after_ms, c.rl_limit, c.rl_remaining, c.rl_reset) == (30000.0, 100, 0, 1700000000)
    assert d.code == "unknown" and d.message == "HTTP 502: <html>bad gateway</html>"
    assert d.retry_after_ms == 0.0 and d.rl_limit is None  # headers not read for an undecodable body


def test_retry_after_rules(spark):
    rows = [(429, "{}", {"Retry-After": v}) for v in ["1.5", "Wed, 21 Oct 2015 07:28:00 GMT", "", "abc"]]
    out = [r.retry_after_ms for r in AG.rate_limit_info(responses(spark, rows)).collect()]
    assert out == [1500.0, 0.0, 0.0, 0.0]


def test_queue_stats_wait_uses_enqueue_time(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 12, 0)
    jobs = spark.createDataFrame(
        [(1, "q", "completed", t, t + dt.timedelta(seconds=10)), (2, "q", "available", t, None)],
        "job_id long, queue string, state string, created_at timestamp, enqueued_at timestamp")
    att = spark.createDataFrame(
        [(1, t + dt.timedelta(seconds=30), 5000, "completed"), (2, t + dt.timedelta(seconds=4), 1000, "failed"),
         (2, t - dt.timedelta(seconds=60), 1000, "failed")],
        "job_id long, started_at timestamp, duration_ms long, outcome string")
    r = AG.queue_stats(jobs, att, t + dt.timedelta(minutes=30)).first()
    assert r.avg_wait_ms == (20000 + 4000) / 2   # the negative wait is left out
    assert (r.completed_last_hour, r.failed_last_hour, r.available) == (1, 2, 1)
    assert r.avg_duration_ms == 5000
