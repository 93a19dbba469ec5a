"""Request validation as column expressions (first failing reason wins).

Messages follow the protocol's wording without its package prefix; lengths are
bytes, patterns are anchored with \\z (see constants).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobledger import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# controls, formats, surrogates, private and unassigned code points, and every
# space or separator but the plain space
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def go_quote(col) -> Column:
    """Double-quoted text: backslash and quote escaped, control characters by
    their letter (``\\n``) or as ``\\x01``, other unprintable ones as
    ``\\u00a0`` or ``\\U000e0001``."""
    c = _c(col)
    esc = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for ch, name in (("\x07", "a"), ("\b", "b"), ("\f", "f"), ("\n", "n"), ("\r", "r"), ("\t", "t"), ("\x0b", "v")):
        esc = F.replace(esc, F.lit(ch), F.lit("\\" + name))

    def one(ch):
        code = F.ascii(ch)  # its code point
        wide = F.when(code < 0x80, F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(code), 2, "0")))) \
                .when(code < 0x10000, F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))) \
                .otherwise(F.concat(F.lit("\\U"), F.lower(F.lpad(F.hex(code), 8, "0"))))
        return F.when(ch.rlike(UNPRINTABLE), wide).otherwise(ch)

    # only texts with such a character are taken apart
    slow = F.concat_ws("", F.transform(F.regexp_extract_all(esc, F.lit("(?s)."), 0), one))
    return F.concat(F.lit('"'), F.when(esc.rlike(UNPRINTABLE), slow).otherwise(esc), F.lit('"'))


def type_reason(col="type") -> Column:
    """NULL when the job type is valid, else the first failing reason."""
    c = _c(col)
    return (F.when(c.isNull() | (c == ""), F.lit("job type is required"))
             .when(F.octet_length(c) > K.MAX_TYPE_BYTES,
                   F.format_string(f"job type must not exceed {K.MAX_TYPE_BYTES} characters, got %d",
                                   F.octet_length(c)))
             .when(~c.rlike(K.TYPE_PATTERN),
                   F.concat(F.lit("invalid job type "), go_quote(c),
                            F.lit(": must match pattern " + K.TYPE_PATTERN_TEXT))))


def queue_reason(col="queue") -> Column:
    """NULL when the queue is valid (empty means the default queue)."""
    c = _c(col)
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
             .when(F.octet_length(c) > K.MAX_QUEUE_BYTES,
                   F.format_string(f"queue name must not exceed {K.MAX_QUEUE_BYTES} characters, got %d",
                                   F.octet_length(c)))
             .when(~c.rlike(K.QUEUE_PATTERN),
                   F.concat(F.lit("invalid queue name "), go_quote(c),
                            F.lit(": must match pattern " + K.QUEUE_PATTERN_TEXT))))


def request_reason(type_col="type", queue_col="queue") -> Column:
    """Type checks first, then the queue (args are never NULL: NULL means [])."""
    return F.coalesce(type_reason(type_col), queue_reason(queue_col))
