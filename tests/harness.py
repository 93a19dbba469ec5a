"""Spark-vs-DuckDB comparison, the same shape as the driver's gate:
row count, column names, order-insensitive multiset of normalised values."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math

import duckdb
import numpy as np
import pandas as pd

from jobledger.sources.tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        r = round(float(v), 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | np.integer):
        return float(v)
    if isinstance(v, pd.Timestamp | dt.datetime):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(_norm(x) for x in v)
    if v is pd.NaT:
        return None
    return v


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = collections.Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(_norm(x) for x in rec)] += 1
    return cols, out


def compare(spark_df, con, sql: str):
    s = spark_df.toPandas()
    d = con.sql(sql).df()
    sc, sr = rows(s)
    dc, dr = rows(d)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} vs {dc}")
    if len(s) != len(d):
        problems.append(f"rows {len(s)} vs {len(d)}")
    if sc == dc and sr != dr:
        only_s = list((sr - dr).items())[:3]
        only_d = list((dr - sr).items())[:3]
        problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    return problems, len(s)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "date": "DATE"}


def type_differences(spark_df, con, sql: str):
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, t, duck_types.get(c)) for c, t in spark_df.dtypes
            if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)]
