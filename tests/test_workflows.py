"""G1, J6, A7-A9 cases."""

from pyspark.sql import functions as F

from jobledger.operators import joins as J
from jobledger.operators import projections as P
from jobledger.operators import workflows as WF

STEP = "struct<type:string,args:string,queue:string,timeout_ms:bigint,priority:int>"


def defs(spark, rows):
    return spark.createDataFrame(rows, f"workflow_id string, kind string, steps array<{STEP}>, "
                                       "callbacks struct<on_complete:struct<type:string,args:string>,"
                                       "on_success:struct<type:string,args:string>,"
                                       "on_failure:struct<type:string,args:string>>")


def step(t, args="{}", queue=None, timeout=None):
    return (t, args, queue, timeout, None)


def test_chain_and_batch_expansion(spark):
    rows = [("c", "chain", [step("a", '{"x":1}'), step("b", queue="fast")], None),
            ("b", "batch", [step("p"), step("q")], (("done", "{}"), ("ok", "{}"), None)),
            ("g", "group", [step("x")], None),
            ("u", "mystery", [step("x")], None),
            ("e", "batch", [], (("done", "{}"), None, None))]
    out = {(r.workflow_id, r.step_id): r for r in WF.expand_workflows(defs(spark, rows)).collect()}
    assert out[("c", "step-0")].depends_on == [] and out[("c", "step-0")].args == '[{"x":1}]'
    assert out[("c", "step-1")].depends_on == ["step-0"]
    assert out[("c", "step-1")].options == '{"queue":"fast"}' and out[("c", "step-0")].options is None
    assert {k[1] for k in out if k[0] == "b"} == {"job-0", "job-1", "on-complete", "on-success"}
    assert out[("b", "on-complete")].depends_on == ["job-0", "job-1"]
    assert out[("g", "job-0")].options is None
    assert not [k for k in out if k[0] == "u"]
    assert out[("e", "on-complete")].depends_on == []


def test_step_options_are_all_written_under_the_rule(spark):
    full = ("struct<type:string,args:string,queue:string,timeout_us:bigint,visibility_timeout_us:bigint,tags:array<string>,"
            f"expires_at:timestamp,retry:{P.RETRY_TYPE},unique:{P.UNIQUE_TYPE}>")
    import datetime as dt
    rest = (61_000_000, ["a"], dt.datetime(2024, 5, 1, 12, 0, 0, 250000), (4, None, None, None, True, []), ([], None, "replace"))
    steps = [("t", "{}", None, None, *rest), ("t", "{}", "default", 0, *rest), ("t", "{}", "fast", None, *rest),
             ("t", "{}", None, 2_000_999, *rest), ("t", "{}", "", None, *rest)]
    d = spark.createDataFrame([("c", "chain", steps, None)], f"workflow_id string, kind string, steps array<{full}>, "
                              "callbacks struct<on_complete:struct<type:string,args:string>,on_success:struct<type:string,args:string>,"
                              "on_failure:struct<type:string,args:string>>")
    got = [r.options for r in WF.expand_workflows(d).orderBy("pos").collect()]
    tail = ('"expires_at":"2024-05-01T12:00:00.25Z","retry":{"max_attempts":4,"jitter":true},"unique":{"on_conflict":"replace"},'
            '"tags":["a"],"visibility_timeout_ms":61000}')
    # neither a queue of its own nor a timeout: the other options are not written
    assert got == [None, None, '{"queue":"fast",' + tail, '{"queue":"default","timeout_ms":2000,' + tail, "{" + tail]


def test_definitions_without_steps_or_callbacks(spark):
    rows = [("b", "batch", None, (("done", None), None, ("bad", "[]"))), ("c", "chain", None, None), ("e", "chain", [], None),
            ("n", None, [step("x")], None)]
    out = {(r.workflow_id, r.step_id): (r.pos, r.args, r.depends_on) for r in WF.expand_workflows(defs(spark, rows)).collect()}
    assert out == {("b", "on-complete"): (0, "[]", []), ("b", "on-failure"): (1, "[]", [])}


def steps_df(spark, rows):
    return spark.createDataFrame(rows, "workflow_id string, step_id string, state string, depends_on array<string>")


def test_callback_readiness(spark):
    rows = [("w", "job-0", "completed", []), ("w", "job-1", "discarded", []),
            ("w", "on-complete", "pending", ["job-0", "job-1"]), ("w", "on-success", "pending", ["job-0", "job-1"]),
            ("w", "on-failure", "pending", ["job-0", "job-1"]), ("w", "next", "pending", ["job-0"])]
    got = {r.step_id: r.ready for r in J.ready_steps(steps_df(spark, rows)).collect()}
    assert got == {"job-0": True, "job-1": True, "on-complete": True, "on-success": False,
                   "on-failure": True, "next": True}


def test_batch_callbacks_and_state(spark):
    rows = [("a", "job-0", "completed", []), ("a", "job-1", "completed", []), ("a", "on-complete", "completed", []),
            ("a", "on-success", "completed", []), ("a", "on-failure", "pending", []),
            ("b", "job-0", "completed", []), ("b", "job-1", "active", []), ("b", "on-complete", "pending", []),
            ("c", "job-0", "discarded", []), ("c", "on-failure", "pending", ["job-0"]),
            ("d", "job-0", "pending", []), ("e", "job-0", "completed", []), ("e", "on-success", "pending", []),
            ("f", "job-0", "completed", [])]
    s = steps_df(spark, rows)
    fired = sorted((r.workflow_id, r.callback) for r in WF.batch_callbacks(s).collect())
    # only callbacks that a workflow defines fire
    assert fired == [("a", "on-complete"), ("a", "on-success"), ("c", "on-failure"), ("e", "on-success")]
    cancelled = spark.createDataFrame([("b",)], "workflow_id string")
    states = {r.workflow_id: r.state for r in WF.workflow_state(s, cancelled).collect()}
    assert states == {"a": "completed", "b": "cancelled", "c": "failed", "d": "pending", "e": "running", "f": "completed"}


def test_cancel_workflow_counts(spark):
    rows = [("w", "s1", "active", []), ("w", "s2", "pending", []), ("w", "s3", "completed", [])]
    ids = spark.createDataFrame([("w",)], "workflow_id string")
    summary, steps = WF.cancel_workflows(steps_df(spark, rows), ids)
    r = summary.first()
    assert (r.steps_cancelled, r.steps_already_completed, r.state) == (2, 1, "cancelled")
    assert sorted(x.state for x in steps.collect()) == ["cancelled", "cancelled", "completed"]


def test_parent_results_long_and_map(spark):
    rows = [("w", "a", "completed", [], "ra"), ("w", "b", "completed", ["a"], "rb"), ("w", "c", "pending", ["a", "b"], None)]
    s = spark.createDataFrame(rows, "workflow_id string, step_id string, state string, depends_on array<string>, result string")
    m = {r.step_id: r.parent_results for r in J.parent_results(s, as_map=True).collect()}
    assert m == {"b": {"a": "ra"}, "c": {"a": "ra", "b": "rb"}}
    assert J.parent_results(s).filter(F.col("step_id") == "c").count() == 2
