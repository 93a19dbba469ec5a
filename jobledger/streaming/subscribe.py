"""Event subscription -- a user callback per event type.

On a static DataFrame each callback receives the events of its type (a
filter over one plan) and its results are returned. On a streaming
DataFrame the same dispatch runs inside ``foreachBatch`` for every
micro-batch (the batch is persisted once and filtered per type).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _dispatch(df: DataFrame, handlers: dict[str, Callable], epoch: int | None = None) -> dict:
    out = {}
    for typ, fn in handlers.items():
        part = df.filter(F.col("type") == typ)
        out[typ] = fn(part) if epoch is None else fn(part, epoch)
    return out


def subscribe(events: DataFrame, handlers: dict[str, Callable], checkpoint: str | None = None,
              trigger: dict | None = None, name: str | None = None):
    """Static: ``{type: fn(events_of_type)}``. Streaming: starts and returns
    the ``StreamingQuery``; callbacks are called as ``fn(batch_df, epoch_id)``
    and should write idempotently (keyed by epoch id). The checkpoint
    defaults to ``<spark.checkpoint.dir>/streams/<name>``."""
    if not events.isStreaming:
        return _dispatch(events, handlers)

    def each(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            _dispatch(batch, handlers, epoch_id)
        finally:
            batch.unpersist()

    if checkpoint is None:
        from jobledger.session import checkpoint_dir
        if not name:
            raise ValueError("give the stream a name or a checkpoint of its own")
        checkpoint = f"{checkpoint_dir(events.sparkSession).rstrip('/')}/streams/{name}"
    w = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
