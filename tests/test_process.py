"""X1-X4 handler processing and the stage chain."""

from pyspark.sql import functions as F

from jobledger.operators import process as X
from jobledger.plans.stages import StageChain


def jobs(spark, rows):
    return spark.createDataFrame(rows, "job_id string, type string, queue string, attempt int, args string, state string")


def test_middleware_order_and_names():
    calls = []

    def mw(name):
        def f(job, nxt):
            calls.append(f"{name}-before")
            r = nxt(job)
            calls.append(f"{name}-after")
            return r
        return f

    p = StageChain().add(mw("first"), "first").add(mw("second"), "second")
    p.wrap(lambda job: calls.append("handler"))({})
    assert calls == ["first-before", "second-before", "handler", "second-after", "first-after"]

    q = StageChain().add(mw("a"), "a")
    q.insert_before("missing", "b", mw("b")).insert_after("missing", "c", mw("c"))
    assert q.names() == ["a", "b", "c"]
    q.insert_before("a", "z", mw("z")).insert_after("z", "y", mw("y")).remove("b").prepend("p", mw("p"))
    assert q.names() == ["p", "z", "y", "a", "c"]
    r = StageChain().add(mw("x")).add(mw("x"))
    assert r.names() == ["middleware-0", "middleware-1"]


def test_process_outcomes(spark):
    def ok(job):
        return {"to": job["args"].get("to")}

    def fails(job):
        raise X.JobError("smtp down")

    def rejects(job):
        raise X.NonRetryable("bad address")

    def panics(job):
        raise KeyError("x")

    df = jobs(spark, [("1", "ok", "q", 1, '{"to":"a@b"}', "available"), ("2", "fails", "q", 1, None, "available"),
                      ("3", "rejects", "q", 1, None, "available"), ("4", "panics", "q", 1, None, "available"),
                      ("5", "nobody", "q", 1, None, "available")])
    h = {"ok": ok, "fails": fails, "rejects": rejects, "panics": panics}
    got = {r.job_id: r for r in X.process(df, h).collect()}
    assert got["1"].state == "completed" and got["1"].result == '{"to":"a@b"}'
    assert (got["2"].error_code, got["2"].error_message, got["2"].error_retryable) == ("handler_error", "smtp down", True)
    assert (got["3"].error_message, got["3"].error_retryable) == ("bad address", False)
    assert got["4"].error_message == "panic in job panics (id=4): 'x'" and got["4"].error_retryable is True
    assert got["5"].error_message == 'no handler registered for job type "nobody"' and got["5"].error_retryable is False
    assert got["1"].duration_ms is not None and got["5"].duration_ms is None
    retry = {r.job_id: r for r in X.process(df, h, on_missing="retry").collect()}
    assert retry["5"].error_retryable is True


def test_drain(spark):
    def fails(job):
        raise ValueError("no")

    df = jobs(spark, [("1", "ok", "q", 0, None, "available"), ("2", "fails", "q", 0, None, "available"),
                      ("3", "none", "q", 0, None, "available"), ("4", "ok", "q", 2, None, "completed")])
    got = {r.job_id: r for r in X.drain(df, {"ok": lambda j: None, "fails": fails}).collect()}
    assert (got["1"].state, got["1"].attempt, got["1"].performed) == ("completed", 1, True)
    assert got["2"].state == "discarded"
    assert got["3"].state == "completed"
    assert (got["4"].state, got["4"].attempt, got["4"].performed) == ("completed", 2, False)


def test_stage_chain_composes_one_plan(spark):
    df = spark.range(10)
    p = StageChain().add(lambda d: d.filter(F.col("id") > 2), "gt2").add(lambda d: d.withColumn("x", F.col("id") * 2), "x")
    p.insert_before("x", "lt8", lambda d: d.filter(F.col("id") < 8))
    out = p.apply(df)
    assert [r.x for r in out.orderBy("id").collect()] == [6, 8, 10, 12, 14]
