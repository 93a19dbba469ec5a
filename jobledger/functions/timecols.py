"""Timestamp helpers that keep arithmetic inside Catalyst expressions.

Ledger timestamps may arrive as TIMESTAMP or TIMESTAMP_NTZ; with the session
zone pinned to UTC both map to the same epoch, so every difference is taken on
epoch microseconds (exact, no boundary-counting semantics).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A timestamp literal (``str`` or ``datetime``) as TIMESTAMP_NTZ."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_us(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def diff_ms(later, earlier) -> Column:
    """``later - earlier`` in milliseconds as DOUBLE (exact to the microsecond)."""
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(1000.0)


def plus_ms(ts, ms) -> Column:
    """``ts + ms`` milliseconds, keeping the timestamp type of ``ts``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    m = F.col(ms) if isinstance(ms, str) else ms
    return t + F.make_dt_interval(secs=m.cast("decimal(38,3)") / 1000)
