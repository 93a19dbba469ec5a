"""Wire-format helpers: RFC3339 timestamps and omit-empty JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rfc3339(col) -> Column:
    """UTC timestamp as RFC3339 with the fraction trimmed (``...T..:..:..[.f]Z``)."""
    c = _c(col).cast("timestamp")
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    frac = F.regexp_replace(F.lpad(micros.cast("string"), 6, "0"), "0+$", "")
    return F.when(c.isNotNull(), F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        F.lit("Z")))


def nonempty_string(col) -> Column:
    c = _c(col)
    return F.when(c != "", c)


def nonzero(col) -> Column:
    c = _c(col)
    return F.when(c != 0, c)


def nonempty_array(col) -> Column:
    c = _c(col)
    return F.when(F.size(c) > 0, c)
