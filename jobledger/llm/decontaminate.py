"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs of letters and digits. Each fixed mask selects some
of a run of consecutive words and ignores the others; the selected words'
hashes of every place in the benchmark are joined with those of every place
in the training texts. A hit fixes an alignment, along which the texts are
compared word by word. An overlap is the longest stretch around hits of which
at least ``SHARE`` agrees, from ``WORDS`` words on (or the whole item, if it
is shorter). The masks find every stretch of 13 words with up to two
substitutions, anywhere in a text. Shorter items have masks of their own
length, which together find every copy that ``SHARE`` allows; of an item of
less than ``LEAST_ITEM`` words only exact copies count.

The benchmark's seeds are broadcast in slices of a bounded number of words;
a larger benchmark takes more passes over the texts and is never cut.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.llm import textvec as V
from jobledger.llm.store import share

# fixed values: 1 selects a word, 0 ignores it
MASKS = ("1110111", "1110010011")
WORDS = 13  # least length of an overlap in words
SHARE = 0.8  # least share of words that agree
LEAST_ITEM = 6  # shorter items count where all their words agree
SLICE_WORDS = 1_000_000  # benchmark words of one broadcast


@dataclass
class Seeds:
    """One slice of the benchmark: its words' hashes, and its sorted seeds."""

    ids: np.ndarray
    words: np.ndarray
    edge: np.ndarray  # words of item i: from edge[i] to edge[i + 1]
    key: np.ndarray
    item: np.ndarray
    place: np.ndarray
    masks: tuple  # those of its items


def masks_of(n: int) -> tuple:
    """The masks of items of ``n`` words. Below ``WORDS``, they are as long as
    the item: it is cut into two blocks more than words may differ, and each
    mask ignores as many blocks as words may differ."""
    if n >= WORDS:
        return MASKS
    differ = n - -(-n * round(SHARE * 10) // 10) if n >= LEAST_ITEM else 0
    block = np.arange(n) * (differ + 2) // n if n else np.zeros(0, int)
    return tuple("".join("0" if b in out else "1" for b in block.tolist()) for out in combinations(range(differ + 2), differ)) if n else ()


def seed_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """The seed of ``mask`` at each place that holds all of it."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, int("1" + mask, 2), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out = (out ^ h[k: k + n]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(29)
    return out


def word_hashes(data, at):
    starts, stops, row = V.words(data, at, V.BARE)
    return V.hashes(data, starts, stops), np.searchsorted(row, np.arange(len(at)))


def index(ids, data, at) -> Seeds:
    h, edge = word_hashes(data, at)
    size = np.diff(edge)
    item = np.repeat(np.arange(len(at) - 1), size)
    none = np.zeros(0, np.int64)
    keys, items, places, masks = [none.astype(np.uint64)], [none], [none], []
    if (size >= WORDS).any():
        masks += MASKS
        for mask in MASKS:
            s = seed_hashes(h, mask)
            ok = np.flatnonzero((item[: len(s)] == item[len(mask) - 1: len(mask) - 1 + len(s)]) & (size[item[: len(s)]] >= WORDS))
            keys.append(s[ok])
            items.append(item[ok])
            places.append(ok - edge[item[ok]])
    for n in np.unique(size[size < WORDS]).tolist():
        own = np.flatnonzero(size == n)
        for mask in masks_of(n):
            masks.append(mask)
            keys.append(seed_hashes(h, mask)[edge[own]])
            items.append(own)
            places.append(np.zeros(len(own), np.int64))
    key, item, place = np.concatenate(keys), np.concatenate(items), np.concatenate(places)
    order = np.argsort(key, kind="stable")
    return Seeds(ids, h, edge, key[order], item[order], place[order], tuple(masks))


def stretch(same: np.ndarray) -> tuple[int, int, int]:
    """The longest run (first, end, agreeing) with at least ``SHARE`` agreeing."""
    tenth = round(SHARE * 10)
    s = np.concatenate([[0], np.cumsum(np.where(same, 10 - tenth, -tenth))])
    most = np.maximum.accumulate(s[::-1])[::-1]
    last = np.searchsorted(-most, -s, side="right") - 1  # of each start, the farthest end that is no lower
    a = int((last - np.arange(len(s))).argmax())
    b = int(last[a])
    return a, b, int(same[a:b].sum())


def overlaps_of(seeds: Seeds, data: np.ndarray, at: np.ndarray) -> list[tuple]:
    """(row, item, agreeing, words, row's first word, item's first word): of
    each row and item the overlap with most agreeing words."""
    h, edge = word_hashes(data, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(edge))
    found = [np.zeros((0, 3), np.int64)]
    seen = np.zeros(1 << 20, bool)
    seen[(seeds.key >> np.uint64(44)).astype(np.int64)] = True
    for mask in seeds.masks:
        s = seed_hashes(h, mask)
        may = np.flatnonzero(seen[(s >> np.uint64(44)).astype(np.int64)])
        may = may[row[may] == row[may + len(mask) - 1]]
        lo, hi = np.searchsorted(seeds.key, s[may]), np.searchsorted(seeds.key, s[may], side="right")
        n = hi - lo
        here = np.repeat(may, n)
        there = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        hits = np.stack([row[here], seeds.item[there], here - edge[row[here]] - seeds.place[there]], 1)
        if len(mask) < LEAST_ITEM:  # exact copies: the first in a row stands for all
            hits = hits[np.unique(hits[:, :2], axis=0, return_index=True)[1]]
        found.append(hits)
    best: dict = {}
    for r, i, d in np.unique(np.concatenate(found), axis=0).tolist():
        first, size, of = int(edge[r]), int(edge[r + 1] - edge[r]), int(seeds.edge[i + 1] - seeds.edge[i])
        a, b = max(0, -d), min(of, size - d)  # of the item, what the row lies along
        same = h[first + d + a: first + d + b] == seeds.words[seeds.edge[i] + a: seeds.edge[i] + b]
        x, y, hits = stretch(same)
        if y - x >= min(WORDS, of) and hits > best.get((r, i), (0,))[0]:
            best[r, i] = (hits, y - x, d + a + x, a + x)
    return [(*k, *v) for k, v in best.items()]


def slices(benchmark: DataFrame, id_col: str, text_col: str) -> list[Seeds]:
    """The benchmark in slices of about ``SLICE_WORDS`` words, indexed. Items
    without a text have no seeds."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    words = rows.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    parts = max(1, -(-words // SLICE_WORDS))
    out = []
    for k in range(parts):
        t = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).orderBy("id", "text").toArrow()
        if len(t):
            data, at = V.buffers(t["text"])
            out.append(index(np.array(t["id"].to_pylist(), object), data[at[0]: at[-1]], at - at[0]))
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per text and benchmark item that overlap: ``id_col``,
    ``item_col``, words (length of the overlap), agreeing, similarity,
    doc_word and item_word (first word of it). Null texts overlap nothing;
    repeated rows are reported each."""
    df = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    fields = [df.schema[id_col], benchmark.schema[item_col], *(T.StructField(c, T.LongType()) for c in ("words", "agreeing")),
              T.StructField("similarity", T.DoubleType()), *(T.StructField(c, T.LongType()) for c in ("doc_word", "item_word"))]
    parts = [_scan(df, seeds, T.StructType(fields)) for seeds in slices(benchmark, item_col, item_text_col)]
    if not parts:
        return df.sparkSession.createDataFrame([], T.StructType(fields))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scan(df: DataFrame, seeds: Seeds, out: T.StructType) -> DataFrame:
    shared = share(df.sparkSession, seeds)
    names = [f.name for f in out]

    def run(batches):
        import pyarrow as pa

        s = shared()
        for batch in batches:
            data, at = V.buffers(batch.column(1))
            for a, b in V.slices(at):
                found = overlaps_of(s, data[at[a]: at[b]], at[a: b + 1] - at[a])
                if not found:
                    continue
                row, item, hits, size, here, there = (np.array(c, np.int64) for c in zip(*found))
                cols = [batch.column(0).take(pa.array(row + a)), pa.array(s.ids[item].tolist()), pa.array(size), pa.array(hits),
                        pa.array(hits / size), pa.array(here), pa.array(there)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that overlap no item."""
    for seeds in slices(benchmark, item_col, item_text_col):
        docs = _clean(docs, seeds, text_col)
    return docs


def _clean(docs: DataFrame, seeds: Seeds, text_col: str) -> DataFrame:
    shared = share(docs.sparkSession, seeds)
    column = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        s = shared()
        for batch in batches:
            data, at = V.buffers(batch.column(column).cast(pa.string()))
            keep = np.ones(len(at) - 1, bool)
            for a, b in V.slices(at):
                for found in overlaps_of(s, data[at[a]: at[b]], at[a: b + 1] - at[a]):
                    keep[a + found[0]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
