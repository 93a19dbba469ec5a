"""Error classification and retryability as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobledger import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def error_class(code="code", status="status") -> Column:
    """Sentinel class of an API error: the code decides first, HTTP 409 is the
    fallback ``conflict``, anything else has no class (NULL)."""
    c, s = _c(code), _c(status)
    expr = None
    for err_code, cls in K.ERROR_CLASSES:
        expr = F.when(c == err_code, F.lit(cls)) if expr is None else expr.when(c == err_code, F.lit(cls))
    return expr.when(s == K.CONFLICT_STATUS, F.lit(K.CONFLICT_CLASS))


def api_retryable(kind="error_kind", retryable="retryable") -> Column:
    """API flavour: a non-retryable mark gives false, a structured API error
    its own flag, any other error false. ``kind`` is one of
    ``marked`` / ``api`` / ``other``; NULL kind means no error (NULL)."""
    k, r = _c(kind), _c(retryable)
    return (F.when(k.isNull(), F.lit(None).cast("boolean"))
             .when(k == "marked", F.lit(False))
             .when(k == "api", F.coalesce(r, F.lit(False)))
             .otherwise(F.lit(False)))


def handler_retryable(kind="error_kind") -> Column:
    """Handler flavour: a non-retryable mark gives false, anything else true."""
    k = _c(kind)
    return F.when(k.isNull(), F.lit(None).cast("boolean")).when(k == "marked", F.lit(False)).otherwise(F.lit(True))


def error_text(code="code", message="message", request_id="request_id") -> Column:
    """``<code>: <message>`` plus `` (request_id=<id>)`` when an id is present."""
    c, m, rid = _c(code), _c(message), _c(request_id)
    base = F.concat_ws(": ", F.coalesce(c, F.lit("")), F.coalesce(m, F.lit("")))
    return F.when(F.coalesce(rid, F.lit("")) != "",
                  F.concat(base, F.lit(" (request_id="), rid, F.lit(")"))).otherwise(base)
