"""Captured API responses -> structured errors.

A status >= 400 becomes an error row. A body that decodes gives its code,
message, retryable flag, details and request id, plus Retry-After and the
rate-limit headers; a body that does not decode gives code ``unknown`` and
message ``HTTP <status>: <body>``, and its headers are not read. Bodies are
never cut: ``oversize`` tells which exceed the protocol's cap in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.operators.aggregations import rate_limit_info


def _kind(v):
    return F.schema_of_variant(v)


def parse_error_responses(df: DataFrame, status: str = "status", body: str = "body",
                          headers: str = "headers", cap: int = K.MAX_RESPONSE_BYTES) -> DataFrame:
    # Intermediates are named columns, each computed once: Catalyst does not
    # inline a non-trivial alias into several consumers, so the body is
    # parsed once per row instead of once per derived field.
    e = (df.filter(F.col(status) >= 400)
           .withColumn("_b", F.col(body))
           .withColumn("_v", F.try_parse_json("_b")))
    e = e.withColumn("_err", F.try_variant_get("_v", "$.error", "variant"))
    fields = {"code": ["STRING"], "message": ["STRING"], "retryable": ["BOOLEAN"], "request_id": ["STRING"]}
    for name in [*fields, "details"]:
        e = e.withColumn(f"_f_{name}", F.try_variant_get("_err", f"$.{name}", "variant"))

    def ok(col, test):
        x = F.col(col)
        return x.isNull() | F.is_variant_null(x) | test(_kind(x))

    checks = [ok(f"_f_{n}", lambda k, kinds=kinds: k.isin(*kinds)) for n, kinds in fields.items()]
    checks.append(ok("_f_details", lambda k: k.startswith("OBJECT")))
    top = F.col("_v").isNotNull() & (_kind(F.col("_v")).startswith("OBJECT") | (_kind(F.col("_v")) == "VOID"))
    decoded = top & ok("_err", lambda k: k.startswith("OBJECT"))
    for c in checks:
        decoded = decoded & c
    e = e.withColumn("_decoded", decoded)

    d = F.col("_decoded")
    e = e.select(
        *[F.col(c) for c in df.columns],
        F.when(d, F.coalesce(F.try_variant_get("_f_code", "$", "string"), F.lit(""))).otherwise(F.lit("unknown"))
         .alias("code"),
        F.when(d, F.coalesce(F.try_variant_get("_f_message", "$", "string"), F.lit("")))
         .otherwise(F.concat(F.lit("HTTP "), F.col(status).cast("string"), F.lit(": "), F.col("_b"))).alias("message"),
        (d & F.coalesce(F.try_variant_get("_f_retryable", "$", "boolean"), F.lit(False))).alias("retryable"),
        F.when(d, F.coalesce(F.try_variant_get("_f_request_id", "$", "string"), F.lit(""))).alias("request_id"),
        F.when(d & F.col("_f_details").isNotNull() & ~F.is_variant_null("_f_details"), F.col("_f_details"))
         .alias("details"),
        F.col(status).alias("http_status"),
        (F.octet_length("_b") > cap).alias("oversize"),
        d.alias("_decoded"))
    info = rate_limit_info(e, headers)
    # headers are only read when the body decoded
    for c in ["retry_after_ms", "rl_limit", "rl_remaining", "rl_reset"]:
        zero = F.lit(0.0) if c == "retry_after_ms" else F.lit(None)
        info = info.withColumn(c, F.when(F.col("_decoded"), F.col(c)).otherwise(zero))
    return info.drop("_decoded")
