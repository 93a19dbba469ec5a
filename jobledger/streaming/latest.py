"""T2 on a stream: a stateful processor whose state leaves the store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from jobledger import constants as K

# the state's rows are many and small, and timers need an ordered store
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "t_us long, t_id long, t_state string, o_us long, o_id long, o_state string, version long, timer long"
CHANGES = "subject string, state string, since_us long, event_id long, final boolean, version long"


class LatestState(StatefulProcessor):
    """Per job: its earliest terminal and its latest other event. A change of
    the current state is a row with a rising ``version``. A timer, ``horizon``
    after the newest event kept, clears a job's state once the watermark has
    passed it."""

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.kept.get() if self.kept.exists() else (None,) * 6 + (0, None)
        term = tuple(old[0:3]) if old[0] is not None else None
        other = tuple(old[3:6]) if old[3] is not None else None
        before = term or other
        for r in rows:
            rec = (r["us"], r["event_id"], r["state"])
            if r["state"] in K.TERMINAL_STATES:
                term = min(term, rec) if term else rec
            else:
                other = max(other, rec) if other else rec
        now, version = term or other, old[6]
        newest = max(x[0] for x in (term, other) if x) // 1000 + self.horizon_ms
        if newest != old[7]:
            if old[7] is not None:
                self.handle.deleteTimer(old[7])
            self.handle.registerTimer(newest)
        version += now != before
        self.kept.update((*(term or (None,) * 3), *(other or (None,) * 3), version, newest))
        if now != before:
            yield Row(subject=key[0], state=now[2], since_us=now[0], event_id=now[1], final=term is not None, version=version)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def state_changes(events: DataFrame, horizon_ms: int, watermark: str) -> DataFrame:
    """Changes of each job's current state: ``CHANGES``. ``events`` is a
    stream with subject, event_id, state and the event time ``_t``. Events
    later than the watermark are dropped."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    e = events.withWatermark("_t", watermark).select("subject", "event_id", "state", F.unix_micros("_t").alias("us"), "_t")
    return e.groupBy("subject").transformWithState(LatestState(horizon_ms), CHANGES, "Update", "EventTime")


def latest_of_changes(changes: DataFrame) -> DataFrame:
    """The current state of each job, from changes with the ``epoch`` that
    wrote them: the last one counts."""
    last = F.max(F.struct("epoch", "version", "state", "since_us", "event_id", "final")).alias("x")
    return changes.groupBy("subject").agg(last).select(
        "subject", "x.state", F.timestamp_micros("x.since_us").cast("timestamp_ntz").alias("since"), "x.event_id", "x.final")
