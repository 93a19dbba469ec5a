"""Cron schedules as rows.

Five fields (minute hour day-of-month month day-of-week) with ``*``, lists,
ranges and steps. Both day fields must match if either starts with ``*``
(``*/2`` included); else either may match. Schedules that are no such text
have no runs; ``cron_errors`` names them.
Run times are generated per schedule from its matching local days, hours and
minutes (output-proportional, no scan of every minute), then mapped to UTC
so that the result equals a UTC minute calendar read in the schedule's zone:
a local time skipped by a DST jump never fires and a repeated one fires
twice.

The audit is a range join (a trigger counts for a run when it falls in
``[run_at, run_at + grace)``) written as an equi-join on (name, bucket of the
grace width) plus the range predicate: a run meets two buckets of triggers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.functions.timecols import epoch_us, ts_lit

# field -> (lowest, highest) value
FIELDS = [("minute", 0, 59), ("hour", 0, 23), ("dom", 1, 31), ("month", 1, 12), ("dow", 0, 7)]


def parse_field(text: Column, lo: int, hi: int) -> Column:
    """One cron field -> sorted ARRAY<INT> of allowed values."""
    def term(t):
        parts = F.split(t, "/")
        base = F.get(parts, 0)
        step = F.coalesce(F.get(parts, 1).try_cast("int"), F.lit(1))
        rng = F.split(base, "-")
        first = F.when(base == "*", F.lit(lo)).otherwise(F.get(rng, 0).try_cast("int"))
        last = (F.when(base == "*", F.lit(hi))
                 .when(F.size(rng) > 1, F.get(rng, 1).try_cast("int"))
                 .when(F.size(parts) > 1, F.lit(hi))
                 .otherwise(first))
        ok = first.isNotNull() & last.isNotNull() & (first <= last) & (step > 0)
        return F.when(ok, F.sequence(first, last, step)).otherwise(F.array().cast("array<int>"))

    vals = F.flatten(F.transform(F.split(F.trim(text), ","), term))
    return F.array_sort(F.array_distinct(F.filter(vals, lambda v: (v >= lo) & (v <= hi))))


def parse_cron(df: DataFrame, col: str = "cron") -> DataFrame:
    """Add one array column per field and the two day-restriction flags."""
    parts = F.split(F.trim(F.col(col)), r"\s+")
    out = df
    for i, (name, lo, hi) in enumerate(FIELDS):
        out = out.withColumn(f"_{name}_txt", F.get(parts, i))
        out = out.withColumn(f"_{name}", parse_field(F.col(f"_{name}_txt"), lo, hi))
    # day of week 7 is Sunday, like 0
    out = out.withColumn("_dow", F.array_distinct(F.transform("_dow", lambda d: F.when(d == 7, 0).otherwise(d))))
    return out.withColumn("_star", F.col("_dom_txt").startswith("*") | F.col("_dow_txt").startswith("*"))


TERM = r"(\*|\d+(-\d+)?)(/[1-9]\d*)?"


def _error(col: str) -> Column:
    """Why a row of ``parse_cron`` is no schedule; NULL if it is one."""
    reason = F.when(F.col(col).isNull() | (F.size(F.split(F.trim(F.col(col)), r"\s+")) != len(FIELDS)), F.lit("expected 5 fields"))
    for name, lo, hi in FIELDS:
        text = F.col(f"_{name}_txt")
        numbers = F.transform(F.regexp_extract_all(F.regexp_replace(text, r"/\d+", ""), F.lit(r"(\d+)"), 1), lambda x: x.try_cast("int"))
        bad = ~text.rlike(rf"^{TERM}(,{TERM})*\z") | F.exists(numbers, lambda v: v.isNull() | (v < lo) | (v > hi)) | (F.size(f"_{name}") == 0)
        reason = reason.when(bad, F.concat(F.lit(f"invalid {name} field "), text))
    return reason


def cron_errors(df: DataFrame, col: str = "cron") -> DataFrame:
    """Rows whose schedule does not parse, with ``cron_error``: the number of
    fields, or the first field that is no list of values, ranges and steps
    within its bounds. These rows have no runs."""
    return parse_cron(df, col).withColumn("cron_error", _error(col)).filter("cron_error IS NOT NULL").select(*df.columns, "cron_error")


def _schedules(cron_jobs: DataFrame) -> DataFrame:
    """The parsed rows that are schedules."""
    return parse_cron(cron_jobs).filter(_error("cron").isNull())


# what a local time's second reading may lie from its first, either way
SHIFTS = [-120, -60, -30, 0, 30, 60, 120]


def _zone(tz_col: str) -> Column:
    return F.coalesce(F.nullif(F.col(tz_col), F.lit("")), F.lit("UTC"))


def _day_matches(day: Column) -> Column:
    dom_ok = F.array_contains("_dom", F.dayofmonth(day))
    dow_ok = F.array_contains("_dow", F.dayofweek(day) - 1)
    return F.array_contains("_month", F.month(day)) & F.when(F.col("_star"), dom_ok & dow_ok).otherwise(dom_ok | dow_ok)


def expand_cron(cron_jobs: DataFrame, start, end, tz_col: str = "timezone") -> DataFrame:
    """Every run time in ``[start, end)`` (UTC) of every schedule:
    ``(name, type, run_at)`` with ``run_at`` a UTC TIMESTAMP_NTZ."""
    lo_u, hi_u = ts_lit(start).cast("timestamp"), ts_lit(end).cast("timestamp")
    tz = _zone(tz_col)
    p = _schedules(cron_jobs)
    first_day = F.date_sub(F.to_date(F.from_utc_timestamp(lo_u, tz)), 1)
    last_day = F.date_add(F.to_date(F.from_utc_timestamp(hi_u, tz)), 1)
    days = p.select("*", F.explode(F.sequence(first_day, last_day)).alias("_day")).filter(_day_matches(F.col("_day")))
    hm = days.select("*", F.explode("_hour").alias("_h")).select("*", F.explode("_minute").alias("_m"))
    local = F.make_timestamp(F.year("_day"), F.month("_day"), F.dayofmonth("_day"), F.col("_h"), F.col("_m"),
                             F.lit(0))
    base = F.to_utc_timestamp(local, tz)
    cands = F.array(*[base + F.expr(f"INTERVAL {m} MINUTE") for m in SHIFTS])
    valid = F.filter(cands, lambda u: (F.from_utc_timestamp(u, tz) == local) & (u >= lo_u) & (u < hi_u))
    runs = hm.select("name", "type", F.explode(valid).alias("_u"))
    return runs.select("name", "type", F.col("_u").cast("timestamp_ntz").alias("run_at"))


# any month, day and weekday that can meet do so within 40 years (a 29 February
# on a given weekday, across a year without one)
CYCLE_MONTHS = 12 * 41
# months looked at before the whole cycle is
NEAR_MONTHS = 13
# runs in a row that may fall into hours skipped by clock changes: a date and
# time do so at most once in some years, or (a fixed Sunday) always
SKIPPED = 8
# clock changes lie on quarter hours and move the clock by at most this
SHIFT_MINUTES = 180


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bits(values: Column) -> Column:
    """Sorted ARRAY<INT> of 0..63 -> BIGINT with these bits set."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda m, v: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), v)))


def _next_bit(mask: Column, at) -> Column:
    """Lowest set bit at or above ``at``; NULL if there is none."""
    rest = mask.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), at if isinstance(at, Column) else F.lit(at)))
    return _let(rest, lambda r: F.when(r != 0, F.bit_count(r.bitwiseAND(-r) - 1).cast("int")))


def _month_days(month: Column) -> Column:
    """Days on which the schedule runs in a month (months since year 0): bit
    ``i`` is day ``i + 1``. The weekday mask, repeated, is moved to the
    month's first weekday, so a month costs a few operations on whole words."""
    def days(first):
        dom = F.shiftright(F.col("_dom_bits"), 1)
        dow = F.call_function("shiftright", F.col("_week_bits"), F.dayofweek(first) - 1)
        both = F.when(F.col("_star"), dom.bitwiseAND(dow)).otherwise(dom.bitwiseOR(dow))
        return both.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(F.last_day(first))) - 1)

    of_year = F.pmod(month, F.lit(12))
    on = F.call_function("shiftright", F.col("_month_bits"), of_year + 1).bitwiseAND(F.lit(1).cast("bigint")) == 1
    first = F.make_date(F.floor(month / 12).cast("int"), of_year + 1, F.lit(1))
    return F.when(on, _let(first, days)).otherwise(F.lit(0).cast("bigint"))


def _next_day(day: Column) -> Column:
    """First day (since the epoch) at or after ``day`` on which the schedule
    runs: its month from that day on, then month by month with carry."""
    date = F.date_from_unix_date(day.cast("int"))
    month = F.year(date) * 12 + F.month(date) - 1

    def look(found, k):
        def hit(bit):
            m = month + k
            first = F.make_date(F.floor(m / 12).cast("int"), F.pmod(m, F.lit(12)) + 1, F.lit(1))
            return F.when(bit.isNotNull(), (F.unix_date(first) + bit).cast("bigint"))

        start = F.when(k == 0, F.dayofmonth(date) - 1).otherwise(F.lit(0))
        return F.when(found.isNotNull(), found).otherwise(_let(_next_bit(_month_days(month + k), start), hit))

    none = F.lit(None).cast("bigint")
    spans = F.array(F.sequence(F.lit(0), F.lit(NEAR_MONTHS)), F.sequence(F.lit(NEAR_MONTHS + 1), F.lit(CYCLE_MONTHS)))
    return F.aggregate(spans, none, lambda found, span: F.when(found.isNotNull(), found).otherwise(F.aggregate(span, none, look)))


def _next_local(minute: Column) -> Column:
    """First local minute (since the epoch) at or after ``minute`` that the
    schedule names: next minute of the hour, else first of the next hour, else
    first of the next day."""
    hours, minutes = F.col("_hour_bits"), F.col("_minute_bits")
    first = _next_bit(hours, 0) * 60 + _next_bit(minutes, 0)
    of_day = F.pmod(minute, F.lit(1440)).cast("int")
    day = F.floor(minute / 1440).cast("bigint")
    h = F.floor(of_day / 60).cast("int")
    here = F.when(_next_bit(hours, h) == h, h * 60 + _next_bit(minutes, of_day % 60))
    later = F.coalesce(here, _next_bit(hours, h + 1) * 60 + _next_bit(minutes, 0))

    def of(time):
        begin = F.when(time.isNull(), day + 1).otherwise(day)
        return _let(_next_day(begin), lambda d: d * 1440 + F.when((d == day) & time.isNotNull(), time).otherwise(first))

    return _let(later, of)


def next_runs(cron_jobs: DataFrame, as_of) -> DataFrame:
    """The first run at or after ``as_of`` per schedule: one row ``(name,
    next_run_at)`` for each schedule that ever runs again. ``as_of``: a time,
    or a column with each schedule's own; NULL gives no row.

    A successor search on bit masks of the five fields, in the row: no
    calendar is unnested and nothing is shuffled. Local times are read in the
    schedule's zone: one that a clock change skips is passed over to the
    change's end, one that it repeats counts at its first reading not before
    ``as_of``; a change that repeats times already passed is a second start of
    the search.
    """
    tz = _zone("timezone")
    p = _schedules(cron_jobs).withColumns({f"_{n}_bits": _bits(F.col(f"_{n}")) for n, _, _ in FIELDS})
    p = p.withColumn("_week_bits", F.col("_dow_bits") * F.lit(sum(1 << 7 * i for i in range(6))))
    t0 = F.ceil(epoch_us(ts_lit(as_of)) / 60_000_000).cast("bigint")

    def local(u):
        return (F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(u * 60), tz)) / 60).cast("bigint")

    def readings(n):
        base = (F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(n * 60), tz)) / 60).cast("bigint")
        return F.filter(F.transform(F.array(*[F.lit(m) for m in SHIFTS]), lambda m: base + m),
                        lambda u: (local(u) == n) & (u >= F.col("_t0")))

    def change(lo, hi, offset):
        """First quarter hour in [lo, hi] at which the zone's offset is ``offset(u)``."""
        at = F.filter(F.sequence(F.ceil(lo / 15).cast("bigint") * 15, hi, F.lit(15).cast("bigint")), offset)
        return F.get(at, 0)

    def after_gap(n):
        # a skipped time is read as if the clock had not moved: past the change
        u = (F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(n * 60), tz)) / 60).cast("bigint")
        return _let(u, lambda x: local(change(x - SHIFT_MINUTES, x, lambda v: local(v) - v == local(x) - x)))

    def search(start):
        def step(s, _):
            def settle(n):
                return _let(F.array_min(readings(n)), lambda u: F.struct(
                    F.when(u.isNull(), F.greatest(after_gap(n), n + 1)).alias("l"), u.alias("u")))

            return F.when(s["u"].isNotNull() | s["l"].isNull(), s).otherwise(_let(_next_local(s["l"]), settle))

        begin = F.struct(start.alias("l"), F.lit(None).cast("bigint").alias("u"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(SKIPPED)), begin, step)["u"]

    p = p.withColumn("_t0", t0).withColumn("_l0", local(F.col("_t0")))
    end = F.col("_t0") + SHIFT_MINUTES
    moved = change(F.col("_t0") + 1, end, lambda u: local(u) - u < F.col("_l0") - F.col("_t0"))
    again = F.when(local(end) - end < F.col("_l0") - F.col("_t0"), local(moved))
    run = F.array_min(F.transform(F.array("_l0", again), search))
    return p.select("name", F.timestamp_seconds(run * 60).cast("timestamp_ntz").alias("next_run_at")).filter("next_run_at IS NOT NULL")


def cron_audit(expected: DataFrame, triggers: DataFrame, grace_seconds: int = 3600) -> DataFrame:
    """Expected runs vs actual trigger events: ``triggered`` when a trigger
    of the same schedule falls in ``[run_at, run_at + grace)``, else
    ``skipped``; ``n_triggers`` counts them.

    Range join as equi-join on (name, bucket of the grace width) -- a run's
    window touches two buckets -- plus the range predicate.
    """
    width = max(1, grace_seconds) * 1_000_000
    bucket = lambda c: F.floor(epoch_us(c) / width).cast("bigint")
    exp = expected.select("name", "run_at", F.explode(F.array(bucket("run_at"), bucket("run_at") + 1)).alias("_b"))
    trg = triggers.select("name", F.col("time").alias("_t"), bucket("time").alias("_b"))
    hi = F.col("run_at") + F.make_dt_interval(secs=F.lit(grace_seconds))
    j = exp.join(trg, ["name", "_b"], "left")
    hit = F.col("_t").isNotNull() & (F.col("_t") >= F.col("run_at")) & (F.col("_t") < hi)
    g = j.groupBy("name", "run_at").agg(F.count_if(hit).alias("n_triggers"))
    return g.select("name", "run_at", F.when(F.col("n_triggers") > 0, "triggered").otherwise("skipped")
                    .alias("status"), "n_triggers")
