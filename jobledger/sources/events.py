"""Event envelopes (type, source, subject, time, data), batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger import schemas as S
from jobledger.functions import decode as D
from jobledger.functions.wire import rfc3339
from jobledger.session import ensure_conf
from jobledger.sources.jobs import CORRUPT


def event_schema() -> T.StructType:
    return T._parse_datatype_string(S.EVENT)


def read_events(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Read event envelopes from JSON lines or parquet, as a batch or a
    stream (same schema, so one operator runs on both). JSON lines are decoded
    strictly; ``split_events`` of the same lines gives those left out."""
    ensure_conf(spark)
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json":
        return parse_events(reader.text(path))
    return reader.schema(event_schema()).format(fmt).load(path)


def split_events(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decode a column of JSON text: ``(events, corrupt)``. A line that is no
    JSON, no object, or has a field of another type (a number as subject, a
    time that is no RFC3339 text, data that is no object) is kept as text in
    ``corrupt``; absent and null fields are NULL."""
    schema = event_schema()
    bound = D.decode(df.select(F.col(col).alias(CORRUPT)), F.col(CORRUPT), schema)
    ok = D.decoded(schema, {"data"})
    return bound.filter(ok).select(*D.values(schema)), bound.filter(~ok).select(CORRUPT)


def parse_events(df: DataFrame, col: str = "value") -> DataFrame:
    """The event envelopes that decode, from a column of JSON text."""
    return split_events(df, col)[0]


def encode_events(df: DataFrame) -> DataFrame:
    """Event rows -> JSON text (``data`` embedded as JSON, time as RFC3339)."""
    return df.select(F.to_json(F.struct(
        "type", "source", "subject", rfc3339("time").alias("time"),
        F.try_parse_json("data").alias("data"))).alias("value"))
