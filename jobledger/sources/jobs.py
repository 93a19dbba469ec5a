"""Job envelopes as JSON lines.

Reading parses each line once into a VARIANT and checks every field against
its wire type, as a typed decoder does: a line that is blank, no JSON, no
object, or has a field of another type is routed aside as text with the other
lines unharmed; ``null`` is an empty envelope. Field names match exactly.
Writing builds the envelope with ``to_json`` on executors; ``args`` is
re-encoded to the wire array, id, type, state, queue and the counters are
always written, and empty optional fields are omitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger import schemas as S
from jobledger.functions import args as A
from jobledger.functions import decode as D
from jobledger.functions.wire import nonempty_array, nonempty_string, nonzero, rfc3339
from jobledger.session import ensure_conf

CORRUPT = "_corrupt_record"

# fields that must hold an object
OBJECTS = {"meta", "result", "details"}


def read_jobs(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Read JSON-lines job envelopes (one or more paths): ``(jobs, corrupt)``.

    Lines are read as text: splittable, one task per file split."""
    ensure_conf(spark)
    return parse_jobs(spark.read.text(path))


def parse_jobs(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decode a column of JSON text: ``(jobs, corrupt)``.

    A line is parsed once and each field bound once (``functions.decode``);
    values that a query does not use are not computed."""
    schema = T._parse_datatype_string(S.JOB_WIRE)
    bound = D.decode(df.select(F.col(col).alias(CORRUPT)), F.col(CORRUPT), schema)
    ok = D.decoded(schema, OBJECTS)
    good = bound.filter(ok).select(*D.values(schema), A.decode_args_variant("_f.args").alias("args_map"), F.col("_f.meta").alias("meta_v"))
    return good, bound.filter(~ok).select(CORRUPT)


def _object(text: Column) -> Column:
    """JSON text as a value to write, if it is an object with entries."""
    v = F.try_parse_json(text)
    canon = F.to_json(v)
    return F.when(canon.startswith("{") & (canon != "{}"), v)


def encode_jobs(df: DataFrame) -> DataFrame:
    """Job rows -> one ``value`` column of JSON envelope text.

    Expects the envelope columns by name (missing optional ones are NULL);
    ``args_map`` (decoded) wins over raw ``args``.
    """
    cols = set(df.columns)

    def col(name, dtype="string"):
        return F.col(name) if name in cols else F.lit(None).cast(dtype)

    def text(name):
        return F.coalesce(col(name).cast("string"), F.lit("")).alias(name)

    # args are always on the wire: an absent or empty map is written as []
    args = A.encode_args(F.col("args_map")) if "args_map" in cols else F.coalesce(col("args"), F.lit("[]"))
    e = col("error", "struct<code:string,message:string,retryable:boolean,details:string>")
    error = F.when(e.isNotNull(), F.struct(
        F.coalesce(e["code"], F.lit("")).alias("code"), F.coalesce(e["message"], F.lit("")).alias("message"),
        F.coalesce(e["retryable"], F.lit(False)).alias("retryable"), _object(e["details"]).alias("details")))
    fields = [
        text("id"), text("type"), text("state"), text("queue"),
        F.coalesce(col("priority", "int"), F.lit(0)).alias("priority"),
        F.coalesce(col("attempt", "int"), F.lit(0)).alias("attempt"),
        F.coalesce(col("max_attempts", "int"), F.lit(0)).alias("max_attempts"),
        nonzero(col("timeout_ms", "bigint")).alias("timeout_ms"),
        nonempty_array(col("tags", "array<string>")).alias("tags"),
        _object(col("meta")).alias("meta"), _object(col("result")).alias("result"), error.alias("error"),
        *[rfc3339(col(t, "timestamp")).alias(t) for t in S.JOB_TIMESTAMPS],
        F.try_parse_json(args).alias("args"),
        nonempty_string(col("previous_state")).alias("previous_state"),
    ]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def write_jobs(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write envelopes as JSON lines (one file per partition, no driver hop)."""
    encode_jobs(df).write.mode(mode).text(path)
