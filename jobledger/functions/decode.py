"""Strict decoding of JSON objects, field by field, in one visit.

A text is parsed once into a VARIANT behind a one-element ``explode``, below
which nothing is pushed. A second one takes all fields in one visit (``_f``),
a third those of nested objects (``_n``), a last one casts each to its wire
type (``_x``). Checks and values read these columns, so a field is visited and
cast once, whatever the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)\z"

# fields that stay JSON text
RAW = {"args", "meta", "result", "details", "data"}


def _visit(v: str, schema: T.StructType) -> str:
    return f"try_variant_get({v}, '$', 'struct<{', '.join(f'{f.name}: variant' for f in schema)}>')"


def _nested(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema if isinstance(f.dataType, T.StructType)]


def _cast(at: str, schema: T.StructType) -> str:
    parts = []
    for f in schema:
        if f.name in RAW:
            continue
        if isinstance(f.dataType, T.StructType):
            parts.append(f"'{f.name}', {_cast(f'_n.{f.name}', f.dataType)}")
        else:
            kind = "string" if isinstance(f.dataType, T.TimestampType) else f.dataType.simpleString()
            parts.append(f"'{f.name}', try_variant_get({at}.{f.name}, '$', '{kind}')")
    return f"named_struct({', '.join(parts)})"


def is_object(v: str) -> str:
    """SQL: an object or ``null``."""
    return f"(is_variant_null({v}) OR startswith(schema_of_variant({v}), 'OBJECT'))"


def _checks(at: str, cast: str, schema: T.StructType, objects: set) -> list[str]:
    out = []
    for f in schema:
        v, x = f"{at}.{f.name}", f"{cast}.{f.name}"
        kind = f"schema_of_variant({v})"
        if f.name in RAW:
            if f.name in objects:
                out.append(f"({v} IS NULL OR {is_object(v)})")
            continue
        if isinstance(f.dataType, T.StringType):
            ok = f"{kind} = 'STRING'"
        elif isinstance(f.dataType, T.BooleanType):
            ok = f"{kind} = 'BOOLEAN'"
        elif isinstance(f.dataType, T.TimestampType):
            ok = f"{kind} = 'STRING' AND {x} RLIKE r'{TIME}' AND try_cast({x} AS TIMESTAMP) IS NOT NULL"
        elif isinstance(f.dataType, T.ArrayType):
            ok = f"{kind} IN ('ARRAY<STRING>', 'ARRAY<VOID>')"
        elif isinstance(f.dataType, T.StructType):
            ok = " AND ".join([f"startswith({kind}, 'OBJECT')", *_checks(f"_n.{f.name}", x, f.dataType, objects)])
        else:
            ok = f"{kind} = 'BIGINT' AND {x} IS NOT NULL"
        out.append(f"({v} IS NULL OR is_variant_null({v}) OR coalesce({ok}, false))")
    return out


def _value(at: str, cast: str, f: T.StructField) -> str:
    v, x = f"{at}.{f.name}", f"{cast}.{f.name}"
    if f.name in RAW:
        return f"CASE WHEN NOT is_variant_null({v}) THEN to_json({v}) END"
    if isinstance(f.dataType, T.StructType):
        return f"CASE WHEN {v} IS NOT NULL AND NOT is_variant_null({v}) THEN {record(f.dataType, f.name)} END"
    if isinstance(f.dataType, T.TimestampType):
        return f"try_cast({x} AS TIMESTAMP)"
    if isinstance(f.dataType, T.ArrayType):
        return f"transform({x}, s -> coalesce(s, ''))"
    return x


def decode(df: DataFrame, text: Column, schema: T.StructType) -> DataFrame:
    """``df`` with ``_v``, the parsed ``text`` (NULL: no JSON), and its fields
    ``_f``, ``_n`` and ``_x``. Objects are nested one deep."""
    out = df.select("*", F.explode(F.array(F.try_parse_json(text))).alias("_v"))
    out = out.select("*", F.expr(f"explode(array({_visit('_v', schema)}))").alias("_f"))
    nested = ", ".join(f"'{f.name}', {_visit(f'_f.{f.name}', f.dataType)}" for f in _nested(schema))
    if nested:
        out = out.select("*", F.expr(f"explode(array(named_struct({nested})))").alias("_n"))
    return out.select("*", F.expr(f"explode(array({_cast('_f', schema)}))").alias("_x"))


def decoded(schema: T.StructType, objects: set = frozenset()) -> Column:
    """True where ``_v`` is an object, or ``null``, whose fields are absent,
    null or of their wire type; those of ``objects`` are objects."""
    return F.expr(f"coalesce({' AND '.join(['_v IS NOT NULL', is_object('_v'), *_checks('_f', '_x', schema, set(objects))])}, false)")


def record(schema: T.StructType, of: str | None = None) -> str:
    """SQL: the struct of the decoded values, or of those of the nested object
    ``of``."""
    at, cast = (f"_n.{of}", f"_x.{of}") if of else ("_f", "_x")
    return "named_struct(" + ", ".join(f"'{f.name}', {_value(at, cast, f)}" for f in schema) + ")"


def values(schema: T.StructType) -> list[Column]:
    """The decoded values as columns; those that a query does not use are left
    out of its plan."""
    return [F.expr(_value("_f", "_x", f)).alias(f.name) for f in schema]
