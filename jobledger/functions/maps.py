"""Map helpers that stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def merge_last_wins(a, b) -> Column:
    """``a`` overlaid with ``b``: keys of ``b`` replace the same keys of ``a``.

    ``map_concat`` refuses duplicate keys by default, so the overlapping keys
    are removed from ``a`` first; a NULL map counts as empty.
    """
    left, right = _c(a), _c(b)
    kept = F.map_filter(left, lambda k, v: ~F.coalesce(F.map_contains_key(right, k), F.lit(False)))
    return (F.when(left.isNull(), right)
             .when(right.isNull(), left)
             .otherwise(F.map_concat(kept, right)))
