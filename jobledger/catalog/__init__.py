"""Named queries over the driver tables, one per operator, with oracles."""

from jobledger.catalog.registry import ORACLE, QUERIES  # noqa: F401
from jobledger.catalog import aggregates, processing, projections, sources, streams, tables, windows, workflows  # noqa: F401  (registers queries)
from jobledger.catalog import flows  # noqa: F401,E402  (composed flows; uses the queries above)
