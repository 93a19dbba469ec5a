"""Message batches and push deliveries."""

import json
from collections import Counter

from jobledger.operators.aggregations import batch_failures
from jobledger.operators.process import JobError, NonRetryable
from jobledger.plans.strategy import literal_frame
from jobledger.sources.events import split_events
from jobledger.sources.messages import handle_deliveries, handle_messages, message_outcomes, read_messages, read_push_deliveries


def test_partial_batch_failure(spark):
    rec = [("msg-1", '{"id":"j1","type":"email.send","args":[]}'),
           ("msg-2", '{"id":"j2","type":"unknown.type","args":[]}'),
           ("msg-3", "{invalid json"),
           ("msg-4", '{"id":"j4","type":"email.send","attempt":"x"}'),
           ("msg-5", '["not","an","object"]')]
    batches = spark.createDataFrame([(1, rec)], "batch_id int, Records array<struct<messageId:string,body:string>>")
    msgs = read_messages(batches, records="Records")
    reg = literal_frame(spark, [("email.send",)], "type string")
    out = message_outcomes(msgs, reg)
    failed = batch_failures(out).first()
    assert failed.failed_ids == ["msg-2", "msg-3", "msg-4", "msg-5"]


def test_push_delivery_bad_body(spark):
    df = spark.createDataFrame([("d1", '{"job":{"id":"j","type":"t"},"worker_id":"w","delivery_id":"d1"}'),
                                ("d2", "not json")], "k string, body string")
    got = {r.k: r for r in read_push_deliveries(df).collect()}
    assert got["d1"].status is None and got["d1"].job.type == "t"
    assert (got["d2"].status, got["d2"].error_code, got["d2"].error_retryable) == ("failed", "invalid_request", False)
    assert got["d2"].error_message == "failed to decode request body"


def test_field_types_are_strict(spark):
    from jobledger.sources.jobs import parse_jobs

    good = ['{"id":"a"}', "null", '{"ID":5,"Id":{}}', '{"error":null,"id":"x","id":"y"}', '{"id":null,"attempt":3,"tags":[null,"x"],"meta":{"a":1},"unknown":5}', '{"created_at":"2024-01-01T00:00:00.5+02:00"}', '{"args":5}']
    bad = ["", " ", "[1]", "5", '"x"', "{", '{"id":5}', '{"attempt":"1"}', '{"attempt":1.5}', '{"attempt":99999999999}', '{"tags":"x"}', '{"tags":[1]}', '{"meta":[1]}',
           '{"error":5}', '{"error":{"retryable":"no"}}', '{"error":{"details":[1]}}', '{"created_at":"2024-01-01"}', '{"created_at":5}', None]
    ok, corrupt = parse_jobs(spark.createDataFrame([(t,) for t in good + bad], "value string"))
    assert ok.count() == len(good) and sorted((r[0] or "") for r in corrupt.collect()) == sorted((t or "") for t in bad)
    row = ok.filter("attempt = 3").first()
    assert (row.id, row.tags, row.meta, row.args) == (None, ["", "x"], '{"a":1}', None)


def test_job_read_by_s1_runs_unchanged(spark):
    from jobledger.operators.process import process
    from jobledger.sources.jobs import parse_jobs

    ok, _ = parse_jobs(spark.createDataFrame([('{"id":"j","type":"t","args":[{"to":"x"}],"attempt":1}',)], "value string"))
    ran = process(ok.withColumnRenamed("id", "job_id"), {"t": lambda job: job["args"]}).first()
    assert (ran.state, ran.result) == ("completed", '{"to":"x"}')


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_field_is_looked_up_twice_at_most(spark):
    from jobledger import schemas
    from jobledger.sources.jobs import parse_jobs

    ok, _ = parse_jobs(spark.createDataFrame([("{}",)], "value string"))
    fields = schemas.JOB_WIRE.count(",") + 1  # the nested ones too
    assert _plan(ok).count("variant_get(") <= 2 * fields + 3  # args: array, first object
    event = schemas.JOB_EVENT.count(",") + 1
    d = read_push_deliveries(spark.createDataFrame([("{}",)], "body string"))
    assert _plan(handle_deliveries(d, {"t": print})).count("variant_get(") <= 2 * (event + 3) + 3


def test_handlers_run_without_a_join_or_shuffle(spark):
    msgs = read_messages(spark.createDataFrame([(1, "m", "{}")], "batch_id int, message_id string, body string"))
    d = read_push_deliveries(spark.createDataFrame([("{}",)], "body string"))
    for df in (handle_messages(msgs, {}), handle_deliveries(d, {})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("MapInArrow") == 1


def _push(id_, typ, **args):
    return (json.dumps({"job": {"id": "j", "type": typ, "args": [args]}, "delivery_id": id_}),)


def test_each_delivery_has_its_own_outcome(spark):
    def odd(job):
        if job["args"]["n"] % 2:
            raise JobError("odd")

    def final(job):
        raise NonRetryable("never")

    rows = [_push("d1", "t", n=0), _push("d1", "t", n=1), _push("d1", "t", n=1), _push(None, "t", n=2), _push("d2", "x"), _push("d3", "f"), ("nope",), (None,), ("null",)]
    d = read_push_deliveries(spark.createDataFrame(rows, "body string").coalesce(1))
    got = sorted(handle_deliveries(d, {"t": odd, "f": final}).collect(), key=str)
    assert Counter(tuple(r) for r in got) == Counter([
        ("d1", "completed", None, None, None), ("d1", "failed", "handler_error", "odd", True), ("d1", "failed", "handler_error", "odd", True),
        (None, "completed", None, None, None), ("d2", "failed", "handler_error", "no handler registered for job type: x", True),
        ("d3", "failed", "handler_error", "never", True), (None, "failed", "invalid_request", "failed to decode request body", False),
        (None, "failed", "invalid_request", "failed to decode request body", False),
        (None, "failed", "handler_error", "no handler registered for job type: ", True)])


def test_each_message_has_its_own_outcome(spark):
    def odd(job):
        if job["args"]["n"] % 2:
            raise JobError("odd")

    body = lambda n: json.dumps({"id": "j", "type": "t", "args": [{"n": n}]})
    rows = [(2**60 + 1, "m", body(0)), (2**60 + 1, "m", body(1)), (None, "n", body(2)), (3, "o", "{"), (3, None, '{"type":"u"}')]
    msgs = read_messages(spark.createDataFrame(rows, "batch_id long, message_id string, body string").coalesce(1))
    got = Counter(tuple(r) for r in handle_messages(msgs, {"t": odd}).collect())
    assert got == Counter([(2**60 + 1, "m", False, None), (2**60 + 1, "m", True, "odd"), (None, "n", False, None),
                           (3, "o", True, "failed to unmarshal message"), (3, None, True, 'no handler registered for job type "u"')])
    assert handle_messages(msgs.limit(0), {"t": odd}).collect() == []


def test_event_lines_are_strict(spark):
    good = ['{}', 'null', '{"type":"a","subject":"s","time":"2024-01-01T00:00:00Z","data":{"x":[1]}}', '{"data":null,"other":1}']
    bad = ['', '5', '[]', '{', '{"subject":5}', '{"type":true}', '{"time":"2024-01-01"}', '{"time":7}', '{"data":5}', '{"data":"x"}', None]
    ok, corrupt = split_events(spark.createDataFrame([(t,) for t in good + bad], "value string"))
    assert ok.count() == len(good) and sorted(r[0] or "" for r in corrupt.collect()) == sorted(t or "" for t in bad)
    row = ok.filter("type = 'a'").first()
    assert (row.subject, row.data, row.time.year) == ("s", '{"x":[1]}', 2024)
