"""Unique-job policy as a greedy fold per key (ours).

A row opens a slot for its key when no slot is open or its time is at least
``anchor + period``; otherwise it conflicts with the open slot. The anchor
never moves on conflict and period 0 never closes. This greedy chain is not
expressible with ``lag`` or tumbling windows, so it runs as an exact parallel
fold, the same for every key and size:

1. (key hash, time, id) alone are cut into slices of about equally many rows
   (``plans.scan``), whatever the period; a hot key runs through many;
2. slices that a key runs through tell, for ways to enter them, the slot that
   is open at their end: all ways if there are few, else samples;
3. the driver follows each such key from slice to slice. Samples bound where a
   slice can be entered, and rounds of finer answers, at most ``LIMIT`` rows a
   slice, settle the slot that is open when each slice begins;
4. every slice is folded on its own from there, batch by batch, with
   ``numpy.searchsorted`` jumps from slot to slot.

The labels are joined back to the rows by id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.functions import args as A
from jobledger.functions.timecols import epoch_us
from jobledger.plans import scan
from jobledger.plans.scan import SLICE

LIMIT = 256  # runs or samples that a slice sends to the driver in a round

STATUS = {"reject": "duplicate", "ignore": "ignored", "replace": "replaced",
          "replace_except_schedule": "replaced"}


def unique_key(type_col: str = "type", args_col: str = "args_map", fields: list[str] | None = None) -> Column:
    """``<type>|<canonical JSON>`` of the listed args fields (missing ->
    null); an empty or missing list uses all args."""
    m = F.coalesce(F.col(args_col), F.create_map().cast(A.ARGS_MAP))
    if fields:
        vals = [F.coalesce(m[f], F.parse_json(F.lit("null"))) for f in sorted(fields)]
        sel = F.map_from_arrays(F.array(*[F.lit(f) for f in sorted(fields)]), F.array(*vals))
        canon = F.to_json(sel)
    else:
        canon = F.to_json(A.sorted_map(m))
    return F.concat(F.col(type_col), F.lit("|"), canon)


def _fold(period_us: int, conflict: str, entries: dict):
    """Label the rows of one slice, sorted by (key, time, id), carrying the
    open slot across batches. ``entries``: slice -> (time, id) of the slot
    that its first key brings along."""
    def run(batches):
        cur_key, anchor_ts, anchor_id = None, None, None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            keys = pdf["_k"].to_numpy()
            t = pdf["_t"].to_numpy(dtype="int64")
            ids = pdf["_id"].to_numpy()
            if cur_key is None and int(pdf[SLICE].iloc[0]) in entries:
                cur_key = keys[0]
                anchor_ts, anchor_id = entries[int(pdf[SLICE].iloc[0])]
            is_anchor = np.zeros(n, dtype=bool)
            slot_anchor = np.empty(n, dtype="int64")
            slot_id = np.empty(n, dtype=object)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [n]))):
                k = keys[s]
                if k != cur_key:
                    cur_key, anchor_ts, anchor_id = k, None, None
                seg = t[s:e]
                i = 0
                if anchor_ts is not None:
                    i = len(seg) if period_us <= 0 else int(np.searchsorted(seg, anchor_ts + period_us, "left"))
                    slot_anchor[s:s + i] = anchor_ts
                    slot_id[s:s + i] = anchor_id
                while i < len(seg):
                    anchor_ts, anchor_id = int(seg[i]), ids[s + i]
                    is_anchor[s + i] = True
                    j = len(seg) if period_us <= 0 else int(np.searchsorted(seg, anchor_ts + period_us, "left"))
                    j = max(j, i + 1)
                    slot_anchor[s + i:s + j] = anchor_ts
                    slot_id[s + i:s + j] = anchor_id
                    i = j
            yield pd.DataFrame({"_k": keys, "_t": t, "_id": ids, "status": np.where(is_anchor, "accepted", STATUS[conflict]),
                                "slot_anchor_us": slot_anchor, "slot_id": pd.Series(slot_id).astype(pdf["_id"].dtype)})
    return run


def _chain_next(t: np.ndarray, period_us: int) -> np.ndarray:
    """Index of the first row at or after ``t[i] + period`` (n if none)."""
    n = len(t)
    if period_us <= 0:
        return np.full(n, n, dtype="int64")
    return np.searchsorted(t, t + period_us, "left").astype("int64")


def _exits(period_us: int, asked: dict, limit: int):
    """Of the last key of each slice in ``asked``: ways to enter the slice and
    the slot that is then open at its end. ``asked[slice]`` is None if the key
    begins in the slice, which is one way; else the slice holds that key only,
    and the ranges of the time ``open + period`` to answer for. Entries in a
    row with one exit are one run, told by its last entry time. If there are
    more than ``limit`` runs, evenly spaced entries are sent as samples, with
    the number of slots that open after them."""
    def run(batches):
        held = []
        for pdf in batches:
            if not len(pdf):
                continue
            slice_ = int(pdf[SLICE].iloc[0])
            own = pdf[pdf["_k"].to_numpy() == pdf["_k"].iloc[-1]]
            held = [*held, own] if held and len(own) == len(pdf) and held[-1]["_k"].iloc[0] == own["_k"].iloc[0] else [own]
        if not held:
            return
        part = pd.concat(held, ignore_index=True)
        t, ids, n = part["_t"].to_numpy(dtype="int64"), part["_id"].to_numpy(), len(part)
        nxt = _chain_next(t, period_us)
        succ, steps = np.where(nxt < n, nxt, np.arange(n)), (nxt < n).astype("int64")
        while True:  # pointer doubling: every row -> last anchor of its chain in the slice
            again = succ[succ]
            if np.array_equal(again, succ):
                break
            steps, succ = steps + steps[succ], again
        ranges, exact = asked[slice_], True
        if ranges is None:
            pick = np.zeros(1, dtype="int64")
        else:
            # a slot from before ends within a period of the slice's first row
            first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            first = first[: int(np.searchsorted(t[first], t[0] + period_us, "left")) + 1]
            spans = [(np.searchsorted(t[first], lo, "left"), np.searchsorted(t[first], hi, "left")) for lo, hi in ranges]
            pick = np.unique(np.concatenate([np.arange(a, min(b + 1, len(first))) for a, b in spans]))
            if not len(pick):
                return
            last = np.r_[(succ[first[pick[1:]]] != succ[first[pick[:-1]]]) | (pick[1:] != pick[:-1] + 1), True]
            exact = int(last.sum()) <= limit
            some = np.unique(np.r_[np.linspace(0, len(pick) - 1, limit).astype("int64"), max(len(pick) - 2, 0)])
            pick = first[pick[last]] if exact else first[pick[some]]
        yield pd.DataFrame({SLICE: slice_, "_entry_t": t[pick], "_exit_t": t[succ[pick]], "_exit_id": ids[succ[pick]], "_steps": steps[pick], "_exact": exact})
    return run


def _merged(ranges: list, most: int = 16) -> list:
    """Closed ranges, sorted and joined where they touch, and over the
    smallest gaps until at most ``most`` are left."""
    out: list = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    while len(out) > most:
        i = min(range(len(out) - 1), key=lambda i: out[i + 1][0] - out[i][1])
        out[i: i + 2] = [(out[i][0], out[i + 1][1])]
    return out


def _image(ranges: list, found: pd.DataFrame, last_t: int, period_us: int) -> list:
    """Where the slot that is open at a slice's end can begin, if the slice is
    entered within ``ranges``. Chains keep their order and interleave, so
    between two samples with equal steps the exits lie between theirs; with
    one step less, they have passed the slice's end."""
    entry, leave, steps = (found[c].to_numpy() for c in ("_entry_t", "_exit_t", "_steps"))
    out = []
    for lo, hi in ranges:
        a, b = int(np.searchsorted(entry, lo, "left")), min(int(np.searchsorted(entry, hi, "left")), len(entry) - 1)
        for j in range(a, b + 1):
            x = int(leave[j])
            if found["_exact"].iloc[0] or j == 0:
                out.append((x, x))
            elif steps[j] == steps[j - 1]:
                out.append((int(leave[j - 1]), x))
            else:
                out += [(int(leave[j - 1]), last_t), (last_t - period_us + 1, x)]
    return _merged(out)


def _entries(cut: DataFrame, period_us: int, id_type: str, limit: int) -> dict:
    """Slice -> (time, id) of the slot that its first key brings along.

    A key that runs through many slices is followed from the first to the
    last. What a slice does to the slot is asked for in rounds, for all slices
    at once: at most ``limit`` runs or samples of each. Samples narrow down
    where the slices after it can be entered, so the next round asks for less;
    the first open slice of each key is entered at one known time, so each
    round settles at least that one."""
    # two keys and two times for each slice
    ends = sorted(cut.groupBy(SLICE).agg(F.min("_k").alias("a"), F.max("_k").alias("b"), F.max("_t").alias("t")).collect())
    chains, last_t = [], {e[SLICE]: e.t for e in ends}
    for x, y in zip(ends[:-1], ends[1:]):
        if x.b != y.a:
            continue
        if chains and chains[-1][-1] == x[SLICE] and x.a == x.b:
            chains[-1].append(y[SLICE])
        else:
            chains.append([x[SLICE], y[SLICE]])
    found, everything = {}, [(-(1 << 62), 1 << 62)]
    while True:
        asked, entries = {}, {}
        for chain in chains:
            start, open_ = found.get(chain[0]), None
            if start is None:
                asked[chain[0]] = None
                ranges = everything
            else:
                open_ = (int(start["_exit_t"].iloc[0]), start["_exit_id"].iloc[0])
                ranges = [(open_[0] + period_us,) * 2]
            for slice_ in chain[1:]:
                entries[slice_] = open_
                if slice_ == chain[-1] or period_us <= 0:
                    continue  # its end is not needed; or the slot never closes
                end, own = last_t[slice_], found.get(slice_)
                inside = [(lo, min(hi, end)) for lo, hi in ranges if lo <= end]
                beyond = [(max(lo, end + 1), hi) for lo, hi in ranges if hi > end]
                if inside and (own is None or not own["_exact"].iloc[0]):
                    asked[slice_] = inside
                if open_ and inside and slice_ not in asked:
                    row = own.iloc[int(np.searchsorted(own["_entry_t"].to_numpy(), inside[0][0], "left"))]
                    open_ = (int(row["_exit_t"]), row["_exit_id"])
                    ranges = [(open_[0] + period_us,) * 2]
                elif inside:
                    open_ = None
                    reach = [(end - period_us + 1, end)] if own is None else _image(inside, own, end, period_us)
                    ranges = _merged(beyond + [(lo + period_us, hi + period_us) for lo, hi in reach])
        if not asked:
            return entries
        schema = f"{SLICE} int, _entry_t long, _exit_t long, _exit_id {id_type}, _steps long, _exact boolean"
        sent = cut.filter(F.col(SLICE).isin(list(asked))).mapInPandas(_exits(period_us, asked, limit), schema).toPandas()
        found.update({int(s): g.sort_values("_entry_t", kind="stable") for s, g in sent.groupby(SLICE)})


def apply_unique(requests: DataFrame, period_ms: int, on_conflict: str = "reject",
                 key_col: str | None = None, fields: list[str] | None = None,
                 ts_col: str = "created_at", id_col: str = "request_id") -> DataFrame:
    """Per request: ``status`` (``accepted`` opens a slot; conflicts are
    ``duplicate`` / ``ignored`` / ``replaced`` by strategy), the slot's
    anchor time ``slot_anchor`` and opening request ``slot_id``.

    A request without a time can hold no slot: its status is ``no_time`` and
    its slot NULL. NULL keys are one key. Ids are unique; repeated rows of one
    id, key and time count once and get the same labels.
    """
    if on_conflict not in STATUS:
        raise ValueError(f"unknown conflict strategy {on_conflict!r}")
    period_us = int(period_ms) * 1000
    df = requests.withColumn("_ukey", F.col(key_col) if key_col else unique_key(fields=fields))
    df = df.withColumn("_k", F.coalesce(F.sha2("_ukey", 256), F.lit(""))).withColumn("_t", epoch_us(ts_col))
    id_type = df.schema[id_col].dataType.simpleString()

    narrow = df.filter(F.col("_t").isNotNull()).select("_k", "_t", F.col(id_col).alias("_id")).distinct()
    cut = scan.slices(narrow, "_k", ["_t", "_id"], ordered=True)
    entries = _entries(cut, period_us, id_type, LIMIT)  # a slot for each slice that a key runs into
    labels = cut.mapInPandas(_fold(period_us, on_conflict, entries),
                             f"_k string, _t long, _id {id_type}, status string, slot_anchor_us long, slot_id {id_type}")

    keys = [F.col(a) == F.col(b) for a, b in (("_k", "_lk"), ("_t", "_lt"))] + [F.col(id_col).eqNullSafe(F.col("_lid"))]
    labels = labels.select(F.col("_k").alias("_lk"), F.col("_t").alias("_lt"), F.col("_id").alias("_lid"), "status", "slot_anchor_us", "slot_id")
    out = df.join(labels, keys[0] & keys[1] & keys[2], "left").withColumn("status", F.coalesce("status", F.lit("no_time")))
    anchor = F.timestamp_micros("slot_anchor_us")
    if dict(requests.dtypes)[ts_col] == "timestamp_ntz":
        anchor = anchor.cast("timestamp_ntz")
    out = out.withColumn("slot_anchor", anchor).drop("_k", "_t", "_lk", "_lt", "_lid", "slot_anchor_us")
    if "unique_key" in requests.columns:
        return out.drop("_ukey")
    return out.withColumnRenamed("_ukey", "unique_key")


def unique_survivors(folded: DataFrame, on_conflict: str = "reject", ts_col: str = "created_at",
                     id_col: str = "request_id") -> DataFrame:
    """One job per slot: ``reject``/``ignore`` keep the first request;
    ``replace`` keeps the last payload and its time; ``replace_except_schedule``
    keeps the last payload with the first run time. Requests without a time
    hold no slot; ``unique_untimed`` has them."""
    folded = folded.filter(F.col("status") != "no_time")
    last = F.max_by(F.col(id_col), F.struct(F.col(ts_col), F.col(id_col)))
    g = folded.groupBy("slot_id").agg(last.alias("_last"), F.min(ts_col).alias("_first_ts"),
                                      F.max(ts_col).alias("_last_ts"), F.count(F.lit(1)).alias("conflicts"))
    if on_conflict in ("reject", "ignore"):
        payload, run_at = F.col("slot_id"), F.col("_first_ts")
    elif on_conflict == "replace":
        payload, run_at = F.col("_last"), F.col("_last_ts")
    else:
        payload, run_at = F.col("_last"), F.col("_first_ts")
    return g.select("slot_id", payload.alias("payload_id"), run_at.alias("run_at"),
                    (F.col("conflicts") - 1).alias("conflicts"))


def unique_untimed(folded: DataFrame) -> DataFrame:
    """The requests that could hold no slot, because they have no time."""
    return folded.filter(F.col("status") == "no_time").drop("status", "slot_id", "slot_anchor")
