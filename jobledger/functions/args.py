"""Job args codec and canonical JSON, as Catalyst expressions on VARIANT.

Wire form is a JSON array. Decoding: a first element that is an object becomes
the args map (later elements are dropped); otherwise elements are keyed by
position ``"0","1",...``; ``[]`` gives an empty map; a non-array is ignored
(NULL). Encoding: empty map -> ``[]``, else ``[<map>]`` with keys sorted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARGS_MAP = "map<string,variant>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse(col) -> Column:
    """JSON text -> VARIANT (NULL when the text is not JSON)."""
    return F.try_parse_json(_c(col))


def decode_args(col) -> Column:
    """Wire args text -> MAP<STRING,VARIANT> (NULL for a non-array)."""
    return decode_args_variant(parse(col))


def decode_args_variant(v) -> Column:
    """Parsed wire args (VARIANT) -> MAP<STRING,VARIANT>. Pass a column that
    holds the parsed value so the text is parsed once per row."""
    v = _c(v)
    arr = F.try_variant_get(v, "$", "array<variant>")
    first_obj = F.try_variant_get(v, "$[0]", ARGS_MAP)
    positional = F.map_from_entries(F.transform(
        arr, lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value"))))
    return (F.when(arr.isNull(), F.lit(None).cast(ARGS_MAP))
             .when(F.size(arr) == 0, F.create_map().cast(ARGS_MAP))
             .when(first_obj.isNotNull(), first_obj)
             .otherwise(positional))


def sorted_map(m) -> Column:
    """The same map with entries ordered by key (JSON encoders sort keys)."""
    entries = F.map_entries(_c(m))
    ordered = F.array_sort(entries, lambda a, b: F.when(a["key"] < b["key"], -1)
                           .when(a["key"] > b["key"], 1).otherwise(0))
    return F.map_from_entries(ordered)


def encode_args(m) -> Column:
    """MAP -> wire text: ``[]`` for NULL/empty, else ``[{...}]`` (keys sorted)."""
    c = _c(m)
    return F.when(c.isNull() | (F.cardinality(c) == 0), F.lit("[]")).otherwise(
        F.concat(F.lit("["), F.to_json(sorted_map(c)), F.lit("]")))


def canonical_json(col) -> Column:
    """Canonical JSON text: object keys sorted, numbers normalised."""
    return F.to_json(parse(col))


def variant_text(v) -> Column:
    """JSON text of a VARIANT value (``null`` for a JSON null)."""
    return F.to_json(_c(v))
