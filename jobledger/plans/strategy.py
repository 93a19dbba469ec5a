"""Physical-plan helpers.

* Small tables built on the driver (handler types, queue settings, schema
  definitions) enter a plan as one JSON literal; whether they are broadcast
  is left to Catalyst and AQE, which measure them.
* Lineage is cut with ``DataFrame.checkpoint()`` into the shared
  ``spark.checkpoint.dir`` (never a local checkpoint).
* Rows that widen after a shuffle are dealt to as many partitions as their
  number asks for: AQE sizes partitions by the compressed bytes it shuffled.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.session import checkpoint_dir

TASK_ROWS = 100_000  # rows of a table that one task sorts or groups


def parts_for(df: DataFrame) -> int:
    """Partitions that give each task ``TASK_ROWS`` of ``df``, a plain table
    (one count, which parquet answers from its footers)."""
    return max(1, -(-df.count() // TASK_ROWS))


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` partitions, which AQE keeps; as
    it is where ``parts`` is None."""
    return df if parts is None else df.repartition(parts, *keys)


def literal_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small table from driver-side rows as a JVM-side inline relation (no
    Python worker, no RDD): one JSON text, read by ``from_json``."""
    st = T._parse_datatype_string(schema)
    names = st.fieldNames()

    def plain(v):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v

    text = json.dumps([{n: plain(v) for n, v in zip(names, r)} for r in rows])
    parsed = F.from_json(F.lit(text), T.ArrayType(st), {"timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"})
    return spark.range(1).select(F.inline(parsed))


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and continue from
    there, so a lost executor recomputes from the files, not the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
