"""End-to-end flows composed from the operators."""

import datetime as dt

from pyspark.sql import functions as F

from harness import SF_SMALL

from jobledger.operators.process import NonRetryable
from jobledger.plans import flows
from jobledger.sources import fixtures as fx


def test_submit_requests(spark):
    req = fx.requests(spark, SF_SMALL)
    jobs, batches = flows.submit_requests(req.drop("unique_key"), unique_period_ms=86_400_000, unique_fields=["k"])
    rows = jobs.collect()
    accepted = batches.filter("accepted").agg(F.sum("n_jobs")).first()[0]
    assert len(rows) == accepted
    assert {r.queue for r in rows} >= {"default"}
    assert {r.unique_status for r in rows} <= {"accepted", "duplicate"}
    ids = sorted(r.id for r in rows)
    assert ids[0] == "job-000001" and ids[-1] == f"job-{len(rows):06d}"


def test_run_jobs_round(spark):
    t = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame(
        [(1, "ok", "a", 1, t, "available", 0, 3), (2, "bad", "a", 5, t, "available", 0, 3),
         (3, "never", "a", 0, t, "available", 0, 3), (4, "ok", "b", 0, t, "available", 0, 3),
         (5, "ok", "a", 0, t, "completed", 1, 3), (6, "hard", "a", 9, t, "available", 2, 3),
         (7, "nobody", "a", 7, t, "available", 0, 3)],
        "job_id long, type string, queue string, priority int, created_at timestamp, state string, attempt int, max_attempts int")
    queues = spark.createDataFrame([("a", "active", 0), ("b", "paused", 1)], "queue string, status string, ord int")

    def bad(job):
        raise ValueError("flaky")

    def hard(job):
        raise NonRetryable("broken")

    out = {r.job_id: r for r in flows.run_jobs(jobs, queues, {"ok": lambda j: {"ok": 1}, "bad": bad, "hard": hard},
                                               per_queue=4, as_of=t).collect()}
    assert out["6"].state == "discarded" and out["6"].attempt == 3           # non-retryable
    assert out["7"].state == "discarded"                                     # no handler: router nack
    assert out["2"].state == "retryable" and out["2"].next_run_at == t + dt.timedelta(seconds=1)
    assert out["1"].state == "completed" and out["1"].result == '{"ok":1}'
    assert out["3"].state == "available"   # ranked 5th in queue a: not picked this round
    assert out["4"].state == "available"   # paused queue
    assert out["5"].state == "completed"


def test_create_workflows(spark):
    from test_workflows import defs, step
    d = defs(spark, [("b", "batch", [step("p"), step("q")], (("done", "{}"), None, None)),
                     ("c", "chain", [step("a"), step("b")], None)])
    steps, ready, state = flows.create_workflows(d)
    r = {(x.workflow_id, x.step_id): x.ready for x in ready.collect()}
    assert r == {("b", "job-0"): True, ("b", "job-1"): True, ("b", "on-complete"): False,
                 ("c", "step-0"): True, ("c", "step-1"): False}
    assert {x.workflow_id: x.state for x in state.collect()} == {"b": "pending", "c": "pending"}
