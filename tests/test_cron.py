"""Cron fields, expansion against a brute-force minute calendar, DST."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from jobledger.operators import schedules as C


def field_py(text, lo, hi):
    out = set()
    for term in text.split(","):
        base, _, step = term.partition("/")
        step = int(step) if step else 1
        if base == "*":
            a, b = lo, hi
        elif "-" in base:
            a, b = map(int, base.split("-"))
        else:
            a = int(base)
            b = hi if step != 1 or "/" in term else a
        out.update(range(a, b + 1, step))
    return out


def matches_py(cron, t):
    m, h, dom, mon, dow = cron.split()
    dows = {d % 7 for d in field_py(dow, 0, 7)}
    dom_ok = t.day in field_py(dom, 1, 31)
    dow_ok = ((t.weekday() + 1) % 7) in dows
    day_ok = dom_ok and dow_ok if dom.startswith("*") or dow.startswith("*") else dom_ok or dow_ok
    return t.minute in field_py(m, 0, 59) and t.hour in field_py(h, 0, 23) and t.month in field_py(mon, 1, 12) and day_ok


def brute(cron, tz, start, end):
    """UTC minute calendar read in the schedule's zone."""
    z = ZoneInfo(tz)
    out = []
    t = start
    while t < end:
        local = t.replace(tzinfo=dt.timezone.utc).astimezone(z).replace(tzinfo=None)
        if matches_py(cron, local):
            out.append(t)
        t += dt.timedelta(minutes=1)
    return out


@pytest.mark.parametrize("cron,tz,start,end", [
    ("*/15 9-10 * * 1-5", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)),
    ("0 0 1,15 * 0", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)),
    ("30 2 * * *", "America/New_York", dt.datetime(2024, 3, 8), dt.datetime(2024, 3, 12)),   # skipped 02:30
    ("30 1 * * *", "America/New_York", dt.datetime(2024, 11, 1), dt.datetime(2024, 11, 5)),  # repeated 01:30
    ("0 9 */2 * *", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20)),
    ("0 9 * * */2", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20)),
    ("0 9 */3 * 1-3", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 20)),
    ("5 4 * 2 7", "Europe/Berlin", dt.datetime(2024, 1, 25), dt.datetime(2024, 2, 20)),
])
def test_expand_matches_minute_calendar(spark, cron, tz, start, end):
    jobs = spark.createDataFrame([("s", cron, tz, "t")], "name string, cron string, timezone string, type string")
    got = sorted(r.run_at for r in C.expand_cron(jobs, start, end).collect())
    assert got == brute(cron, tz, start, end)


NEXT = [("daily", "0 9 * * *", "UTC"), ("weekly", "0 9 * * 1", "UTC"), ("monthly", "0 9 1 * *", "UTC"), ("range", "15-20/5 8-9 1-7 6 1,3", "UTC"),
        ("berlin", "30 2 * * *", "Europe/Berlin"), ("leap", "0 0 29 2 *", "UTC"), ("passed", "0 9 1 1 *", "America/New_York"), ("now", "0 10 * * *", "UTC")]


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 3, 30, 23, 30), dt.datetime(2023, 12, 31, 23, 59)])
def test_next_run_matches_minute_calendar(spark, as_of):
    jobs = spark.createDataFrame([(*n, "t") for n in NEXT], "name string, cron string, timezone string, type string")
    got = {r.name: r.next_run_at for r in C.next_runs(jobs, str(as_of)).collect()}
    for name, cron, tz in NEXT:
        z, t, step = ZoneInfo(tz), as_of, dt.timedelta(minutes=1)
        while not matches_py(cron, t.replace(tzinfo=dt.timezone.utc).astimezone(z).replace(tzinfo=None)):
            t += step
        assert got[name] == t, name


def test_next_run_far_away_and_never(spark):
    jobs = spark.createDataFrame([("leap monday", "0 0 29 2 */7", "UTC", "t"), ("never", "0 0 31 2 *", "UTC", "t"), ("bad", "0 9 * * MON", "UTC", "t"), ("none", None, "UTC", "t")],
                                 "name string, cron string, timezone string, type string")
    got = {r.name: r.next_run_at for r in C.next_runs(jobs, "2080-03-01 00:00:00").collect()}
    assert got == {"leap monday": dt.datetime(2088, 2, 29)}  # the first 29 February on a Sunday


def test_cron_errors(spark):
    texts = ["0 9 * * *", "0 9 * * MON", "nonsense", "61 * * * *", "* * 0 * *", "*/0 * * * *", "1-70 * * * *", None, "5-1 * * * *", "0 0 1,15 */2 7"]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(texts)], "name string, cron string")
    got = {r.name: r.cron_error for r in C.cron_errors(df).collect()}
    assert got == {"1": "invalid dow field MON", "2": "expected 5 fields", "3": "invalid minute field 61", "4": "invalid dom field 0",
                   "5": "invalid minute field */0", "6": "invalid minute field 1-70", "7": "expected 5 fields", "8": "invalid minute field 5-1"}


def test_audit_range_join(spark):
    exp = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, 23, 0)), ("s", dt.datetime(2024, 1, 2, 9, 0))],
                                "name string, run_at timestamp_ntz")
    trg = spark.createDataFrame([("s", dt.datetime(2024, 1, 2, 0, 30)), ("s", dt.datetime(2024, 1, 2, 12, 0))],
                                "name string, time timestamp_ntz")
    got = {r.run_at.hour: (r.status, r.n_triggers) for r in C.cron_audit(exp, trg, grace_seconds=7200).collect()}
    assert got == {23: ("triggered", 1), 9: ("skipped", 0)}
