"""LM scoring: an interpolated modified Kneser-Ney n-gram model.

Counting runs in Spark. Each task turns its texts into word hashes, counts
its n-grams, and sends one packed block of them to each shard; an n-gram's
shard follows from its context, and for contexts made of frequent words only
from the whole n-gram, so that no frequent word fills a shard. A shard sums
its n-grams, writes their sorted hashes to the shared folder, and passes on
context totals and the distinct suffixes, which are the next lower level's
continuation counts. Blocks write words as ranks by frequency (``Ranks``, a
file that tasks map), which need half the bytes of hashes. Scoring tasks map
the shards' files and search them.

A shard has one file a level: ``one`` (sorted hashes of n-grams counted once,
see ``bucketed``), ``many`` and ``count`` (the others and their counts), and, of the
contexts that lie in the shard whole, ``ctx1`` (sorted hashes of those seen
once), ``ctx`` and ``s0`` to ``s3`` (the others; their total and numbers of
n-grams counted once, twice and more often). Contexts of frequent words alone,
which are in many shards, are added up in files of their own. The model knows
all files with their lengths; a missing one is an error.

Everything grows with the corpus and nothing is cut off: memory per task is
bounded by ``FLUSH`` n-grams and one shard, files by the distinct n-grams. A
scoring task keeps ``MAPPED`` files mapped at most.
"""

from __future__ import annotations

import json
import os
import struct
from collections import OrderedDict
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.llm import textvec as V
from jobledger.llm.store import load, save, shared_folder
from jobledger.plans.strategy import cut_lineage

BEGIN, END = np.uint64(0x1B5E2F7A9C3D4E61), np.uint64(0x7C159E3779B97F4A)
FLUSH = 2_000_000  # n-grams that a task holds before it sends them on
SHARD_BYTES = 16 << 20  # text bytes for each shard
MAPPED = 1024  # files that a scoring task keeps mapped
RANKED_BITS = 22  # a word has a rank from two tokens and a 2**-RANKED_BITS of all, so at most 2**RANKED_BITS do
HOT_SHARE = 8  # a word is frequent from 1 / (HOT_SHARE * shards) of all tokens

BLOCK = "level int, kind string, shard int, blob binary, n bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, total bigint"


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row's end included; their rows; and
    their places in the row."""
    starts, stops, row = V.words(data, at)
    n, rows = len(starts), len(at) - 1
    per_row = np.bincount(row, minlength=rows)
    out = np.empty(n + rows, np.uint64)
    out[np.arange(n) + row] = V.hashes(data, starts, stops)
    last = np.cumsum(per_row + 1) - 1
    out[last] = END
    of = np.repeat(np.arange(rows), per_row + 1)
    place = np.arange(n + rows) - (last - per_row)[of]
    return out, of, place


def ngram_columns(tok: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """The words of the n-gram that ends at each token, first word first."""
    out = []
    for back in range(order - 1, 0, -1):
        col = np.full(len(tok), BEGIN, np.uint64)
        col[back:] = tok[:-back] if len(tok) > back else tok[:0]
        col[place < back] = BEGIN
        out.append(col)
    return [*out, tok]


def chained(cols: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of word hashes."""
    h = cols[0]
    for c in cols[1:]:
        h = V.chain(h, c)
    return h


def pick(h: np.ndarray, shards: int) -> np.ndarray:
    return ((V.mix(h) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in ``sorted_keys``, and which of them are there."""
    if len(sorted_keys) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == keys


def bucketed(name: str, keys: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hashes as two arrays: where each bucket of equal leading bits
    begins, and the next 32 bits of each. A bucket holds 8 to 16 hashes, so a
    hash that is not there is taken for one that is about once in 2**28."""
    bits = max(0, len(keys).bit_length() - 4)
    lead = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    first = np.searchsorted(lead, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
    return {f"{name}_at": first, name: (keys >> np.uint64(32 - bits)).astype(np.uint32)}


def find_bucketed(first: np.ndarray, rest: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` among ``bucketed`` hashes, and which are there."""
    bits = (len(first) - 1).bit_length() - 1
    if len(rest) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    lead = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    low, high, key = first[lead].astype(np.int64), first[lead + 1].astype(np.int64), (keys >> np.uint64(32 - bits)).astype(np.uint32)
    for k in range(int((high - low).max(initial=0)).bit_length() - 1, -1, -1):
        up = low + ((1 << k) - 1)
        less = rest.take(up, mode="clip") < key
        less &= up < high
        low += less.astype(np.int64) << k
    at = np.minimum(low, len(rest) - 1)
    return at, (low < high) & (rest[at] == key)


def gram_shard(cols: list[np.ndarray], hot: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each n-gram: by its context, or by the whole n-gram where it
    has no context or all words of the context are frequent."""
    if len(cols) == 1:
        return pick(cols[0], shards)
    h = chained(cols[:-1])
    return pick(np.where(frequent(cols[:-1], hot), V.chain(h, cols[-1]), h), shards)


def frequent(cols: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    """Rows whose words are all frequent (a text's beginning is)."""
    whole = np.ones(len(cols[0]), bool)
    for c in cols:
        whole &= find(hot, c)[1] | (c == BEGIN)
    return whole


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal rank together, so that compression finds them."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


class Ranks:
    """The most frequent words as ranks, which blocks write instead of hashes.
    A word has one slot, by its leading bits; one that lost its slot to a more
    frequent word counts as not listed, which costs bytes and nothing else."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.words, self.slot = arrays["words"], arrays["slot"]
        self.shift = np.uint64(65 - len(self.slot).bit_length())

    @staticmethod
    def arrays(words: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """``BEGIN``, which is no token, and ``words`` from most to least frequent."""
        words = np.concatenate([[BEGIN], words[np.lexsort((words, counts))[::-1]]]).astype(np.uint64)
        bits = len(words).bit_length() + 2
        slot = np.zeros(1 << bits, np.uint32)
        slot[(words >> np.uint64(64 - bits))[::-1]] = np.arange(len(words), dtype=np.uint32)[::-1]
        return {"words": words, "slot": slot}

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of ``words``, and which are listed."""
        rank = self.slot[words >> self.shift]
        return rank, self.words[rank] == words


def pack(cols: list[np.ndarray], counts: np.ndarray, words: bool = True, ranks: Ranks | None = None) -> bytes:
    """Rows of ``cols`` and a count, sorted by the first two columns. Columns
    of ``words`` hold ``ranks``, and beyond these places in a sorted list of
    the block's other words. Without ranks, columns that repeat their words
    share one list of all of them; others are written as they are."""
    import zstandard

    n, listed = len(counts), 0
    known = cols[0][:0]
    if words and ranks is not None:
        listed, flat = len(ranks.words), np.concatenate(cols)
        place, there = ranks.of(flat)
        known, other = np.unique(flat[~there], return_inverse=True)
        place[~there] = other + listed
        cols = list(place.reshape(len(cols), n))
    elif words:
        some, place = np.unique(np.concatenate(cols), return_inverse=True)
        if 8 * len(some) < 5 * len(cols) * n:
            known, cols = some, list(place.reshape(len(cols), n).astype(np.uint32))
    if listed and len(cols) > 1:
        order = np.argsort((cols[0].astype(np.uint64) << np.uint64(32)) | cols[1])
    else:
        order = np.lexsort(cols[1::-1])
    out = [struct.pack("<qqqq", n, len(cols), len(known), listed), planes(np.diff(known, prepend=np.uint64(0)))]
    for k, c in enumerate(cols):
        c = c[order]
        out.append(planes(np.diff(c, prepend=c.dtype.type(0)) if k == 0 else c))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*out, planes(counts[order].astype(np.uint64))]))


def unpack(blob: bytes, ranks: Ranks | None = None) -> list[np.ndarray]:
    import zstandard

    blob = zstandard.ZstdDecompressor().decompress(blob)
    (n, k, m, listed), at = struct.unpack_from("<qqqq", blob), 32

    def take(count, kind):
        nonlocal at
        width = np.dtype(kind).itemsize
        raw = np.frombuffer(blob, np.uint8, count * width, at).reshape(width, count)
        at += count * width
        return np.ascontiguousarray(raw.T).reshape(-1).view(kind)

    known, parts = np.cumsum(take(m, np.uint64), dtype=np.uint64), []
    for i in range(k):
        part = take(n, np.uint32 if m or listed else np.uint64)
        part = np.cumsum(part, dtype=part.dtype) if i == 0 else part
        if listed:
            other = part >= listed
            column = ranks.words[np.where(other, 0, part)]
            column[other] = known[part[other] - listed]
            parts.append(column)
        else:
            parts.append(known[part] if m else part)
    return [*parts, take(n, np.uint64)]


def unite(blobs, ranks: Ranks | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of many blocks with summed counts: columns, sums, and
    the sorted hashes of the rows."""
    parts = [unpack(b, ranks) for b in blobs]
    cols = []
    while parts[0]:
        cols.append(np.concatenate([p.pop() for p in parts]))
    counts, *cols = cols
    cols.reverse()
    return distinct(cols, counts)


def distinct(cols, counts):
    key = chained(cols)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first = order[new]
    return [c[first] for c in cols], np.add.reduceat(counts[order], new) if len(new) else counts[:0], key[new]


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds all of them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def row(level, kind, shard, blob=None, n=0, ns=(0, 0, 0, 0), total=0):
    return (level, kind, int(shard), blob, int(n), *(int(x) for x in ns), int(total))


def frame(rows) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in BLOCK.split(", ")])


def blocks(level, kind, cols, counts, shard, ranks=None):
    """A packed block for each shard."""
    order = by_number(shard)
    shard = shard[order]
    cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), [len(shard)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        at = order[a:b]
        yield row(level, kind, shard[a], pack([c[at] for c in cols], counts[at], ranks=ranks), b - a)


def by_number(shard: np.ndarray) -> np.ndarray:
    """Order of shard numbers, which numpy sorts fastest in 16 bits."""
    return np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")


def count_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def counter(order: int, shards: int, hot: np.ndarray, ranked: tuple | None = None):
    """Map side: partial counts of the n-grams of ``order`` words, by shard.
    ``ranked``: path and size of the file of ``Ranks``."""

    def run(batches):
        import pyarrow as pa

        ranks = Ranks(load(*ranked)) if ranked else None
        names = [x.split()[0] for x in BLOCK.split(", ")]
        kinds = pa.schema([("level", pa.int32()), ("kind", pa.string()), ("shard", pa.int32()), ("blob", pa.binary()), *((x, pa.int64()) for x in names[4:])])

        def send(held):
            cols, counts, _ = distinct([np.concatenate([h[0][i] for h in held]) for i in range(order)], np.concatenate([h[1] for h in held]))
            for r in blocks(order, "gram", cols, counts, gram_shard(cols, hot, shards), ranks):
                yield pa.RecordBatch.from_pylist([dict(zip(names, r))], kinds)

        held, size = [], 0
        for batch in batches:
            data, at = V.buffers(batch.column(0))
            for a, b in V.slices(at):
                tok, _, place = tokens(data[at[a]: at[b]], at[a: b + 1] - at[a])
                cols = ngram_columns(tok, place, order)
                cols, counts, _ = distinct(cols, np.ones(len(tok), np.int64))
                held.append((cols, counts))
                size += len(counts)
                if size > FLUSH:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    return run


def context_arrays(head: np.ndarray, stats: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Sorted contexts and their sums, those seen once as hashes alone."""
    once = stats[0] == 1
    return {**bucketed("ctx1", head[once]), **bucketed("ctx", head[~once]), **{f"s{i}": narrow(c[~once]) for i, c in enumerate(stats)}}


def summer(folder: str, order: int, shards: int, hot: np.ndarray, raw: bool, ranked: tuple | None = None):
    """Reduce side: write one shard's file, pass on what the next level needs."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        level, kind, shard = (x.item() if hasattr(x, "item") else x for x in key)
        out = []

        def keep(name, arrays):
            name = f"{name}-{shard}"
            out.append(row(level, "file", shard, name.encode(), save(f"{folder}/{name}", arrays)))

        if kind == "ctx":
            parts = [unpack(b) for b in pdf["blob"]]
            whole = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
            at, new = by_key(whole[0])
            keep(f"h{level}", context_arrays(whole[0][at][new], [np.add.reduceat(c[at], new) for c in whole[1:]]))
            return frame(out)
        ranks = Ranks(load(*ranked)) if ranked else None
        cols, counts, keys = unite(pdf["blob"], ranks)
        once = counts == 1
        arrays = {**bucketed("one", keys[once]), **bucketed("many", keys[~once]), "count": narrow(counts[~once])}
        out.append(row(level, "sum", shard, None, len(keys), [*count_of_counts(counts)], counts.sum()))
        if raw:
            often = counts * 10_000 >= counts.sum()
            out.append(row(level, "top", shard, np.stack([cols[0][often], counts[often].astype(np.uint64)]).tobytes()))
            often = counts >= max(2, int(counts.sum()) * shards >> RANKED_BITS)
            out.append(row(level, "rank", shard, np.stack([cols[0][often], counts[often].astype(np.uint64)]).tobytes()))
        elif level > 1:
            ctx = chained(cols[:-1])
            at, new = by_key(ctx)
            s = counts[at]
            ends = [np.add.reduceat(x.astype(np.uint64), new) for x in (s, s == 1, s == 2, s > 2)]
            first = at[new]
            head, spread = ctx[first], frequent([c[first] for c in cols[:-1]], hot)
            arrays |= context_arrays(head[~spread], [e[~spread] for e in ends])
            by = pick(head, shards)
            for k in np.unique(by[spread]):
                m = spread & (by == k)
                out.append(row(level, "ctx", k, pack([head[m], *(e[m] for e in ends[:-1])], ends[-1][m], words=False)))
            tail = cols[1:]
            # n-grams at a text's beginning have no longer form: they keep their counts
            weight = np.where(tail[0] == BEGIN, counts, 1) if level > 2 else np.ones(len(counts), np.int64)
            tail, weight, _ = distinct(tail, weight)
            out += blocks(level - 1, "gram", tail, weight, gram_shard(tail, hot, shards), ranks)
        keep("raw" if raw else str(level), arrays)
        return frame(out)

    return run


def by_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    s = key[order]
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """A counted model: its folder, with a list of its files, and the few
    numbers that scoring needs."""

    folder: str
    listed: int  # bytes of the list of files
    order: int
    shards: int
    hot: tuple
    tokens: int  # training tokens, ends included
    vocabulary: int  # distinct training tokens
    levels: tuple  # of each level, from 1: total, n1, n2, n3 and more, discounts of 1, 2, 3 and more


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; where one of these
    is 0, as in a tiny corpus, half of the count class."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and b else k / 2
        out.append(min(max(d, 0.05), k))
    return tuple(out)


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count ``docs`` and write the model's files below ``spark.checkpoint.dir``.

    Null texts count as empty (one end each); no row at all gives a model
    that knows nothing and scores every token alike.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "ngrams")
    docs = docs.select(F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))  # fewer, larger blocks repeat fewer words
    none = np.zeros(0, np.uint64)

    words = (docs.mapInArrow(counter(1, shards, none), BLOCK)
             .groupBy("level", "kind", "shard").applyInPandas(summer(folder, 1, shards, none, True), BLOCK))
    words = cut_lineage(words)
    total, vocabulary = (x or 0 for x in words.filter("kind = 'sum'").agg(F.sum("total"), F.sum("n")).first())
    # HOT_SHARE * shards words at most
    hot = [w for r in words.filter("kind = 'top'").select("blob").mapInPandas(often(HOT_SHARE * shards, total), "words binary").collect() for w in np.frombuffer(r.words, np.uint64)]
    hot = np.sort(np.array(hot, np.uint64))

    listed = [np.frombuffer(r.blob, np.uint64).reshape(2, -1) for r in words.filter("kind = 'rank'").select("blob").collect()]
    listed = np.concatenate([np.zeros((2, 0), np.uint64), *listed], axis=1)
    ranked = (f"{folder}/ranks", save(f"{folder}/ranks", Ranks.arrays(*listed)))

    # a few short rows for each shard and level
    found = words.filter("kind = 'file'").collect()
    rows = docs.mapInArrow(counter(order, shards, hot, ranked), BLOCK)
    for _ in range(order):
        with shuffles_released(spark):
            rows = cut_lineage(rows.groupBy("level", "kind", "shard").applyInPandas(summer(folder, order, shards, hot, False, ranked), BLOCK))
        found += rows.filter("kind IN ('sum', 'file')").collect()
        rows = rows.filter("kind NOT IN ('sum', 'file')")
    listed = json.dumps({r.blob.decode(): r.n for r in found if r.kind == "file"})
    with open(f"{folder}/files.json", "w") as f:
        f.write(listed)
    sums: dict = {}
    for r in found:
        if r.kind == "sum":
            sums[r.level] = [a + b for a, b in zip(sums.get(r.level, [0] * 6), (r.n, r.n1, r.n2, r.n3, r.n4, r.total))]
    levels = []
    for level in range(1, order + 1):
        n, n1, n2, n3, n4, every = sums.get(level, [0] * 6)
        levels.append((every, n1, n2, n - n1 - n2, *discounts(n1, n2, n3, n4)))
    return Model(folder, len(listed), order, shards, tuple(hot.tolist()), total, vocabulary, tuple(levels))


@contextmanager
def shuffles_released(spark):
    """Let a query's shuffle files go when it ends, not when they are garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def often(parts: int, total: int):
    """Of the words of each shard that may be frequent, those with a
    ``parts``-th of all tokens."""

    def run(batches):
        for pdf in batches:
            tables = [np.frombuffer(b, np.uint64).reshape(2, -1) for b in pdf["blob"]]
            yield pd.DataFrame({"words": [t[0][t[1] * np.uint64(parts) >= np.uint64(max(total, 1))].tobytes() for t in tables]})

    return run


class Searcher:
    """One worker's view of a model: mapped files, searched shard by shard."""

    def __init__(self, model: Model):
        self.m, self.hot, self.mapped = model, np.array(model.hot, np.uint64), OrderedDict()
        path = f"{model.folder}/files.json"
        if not os.path.exists(path) or os.path.getsize(path) != model.listed:
            raise FileNotFoundError(f"{path} is missing or not whole; do all executors see the shared folder?")
        with open(path) as f:
            self.sizes = json.load(f)

    def array(self, file, name):
        """An array of a file; an empty one if the model has no such file."""
        if file not in self.sizes:
            return np.zeros(0, np.uint64)
        if file in self.mapped:
            self.mapped.move_to_end(file)
        else:
            self.mapped[file] = load(f"{self.m.folder}/{file}", self.sizes[file])
            if len(self.mapped) > MAPPED:
                self.mapped.popitem(last=False)
        return self.mapped[file].get(name, np.zeros(0, np.uint64))

    def find(self, file, name, keys):
        return find_bucketed(self.array(file, f"{name}_at"), self.array(file, name), keys)

    def by_shard(self, keys, shard, look, width):
        """``look`` at the sorted ``keys`` of each shard."""
        out = np.zeros((len(keys), width), np.int64)
        order = by_number(shard)
        s = shard[order]
        cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])), [len(s)]]) if len(s) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            out[order[a:b]] = look(int(s[a]), keys[order[a:b]])
        return out

    def counts(self, name, keys, shard):
        def look(k, q):
            c = self.find(f"{name}-{k}", "one", q)[1].astype(np.int64)
            rest = np.flatnonzero(c == 0)
            at, there = self.find(f"{name}-{k}", "many", q[rest])
            if there.any():
                c[rest[there]] = self.array(f"{name}-{k}", "count")[at[there]]
            return c[:, None]

        return self.by_shard(keys, shard, look, 1)[:, 0]

    def contexts(self, level, keys, spread):
        """Total and numbers of n-grams of each context; ``spread``: those of
        frequent words alone."""
        def look(name):
            def run(k, q):
                file = f"{name}-{k}"
                out = np.zeros((len(q), 4), np.int64)
                once = self.find(file, "ctx1", q)[1]
                out[once] = (1, 1, 0, 0)
                rest = np.flatnonzero(~once)
                at, there = self.find(file, "ctx", q[rest])
                if there.any():
                    out[rest[there]] = np.stack([self.array(file, f"s{i}")[at[there]] for i in range(4)], 1)
                return out
            return run

        out = np.zeros((len(keys), 4), np.int64)
        for name, m in ((f"h{level}", spread), (str(level), ~spread)):
            out[m] = self.by_shard(keys[m], pick(keys[m], self.m.shards), look(name), 4)
        return out

    def discounted(self, c, level):
        d = np.array([0.0, *self.m.levels[level - 1][4:]])
        return np.maximum(c - d[np.minimum(c, 3)], 0.0)

    def word_tables(self, words):
        """Training counts, and the lowest level's probabilities."""
        raw = self.counts("raw", words, pick(words, self.m.shards))
        total, n1, n2, n3, d1, d2, d3 = self.m.levels[0]
        spare = 1.0 / (self.m.vocabulary + 1)
        if not total:
            return raw, np.full(len(words), spare)
        c = self.counts("1", words, pick(words, self.m.shards))
        return raw, self.discounted(c, 1) / total + (d1 * n1 + d2 * n2 + d3 * n3) / total * spare

    def score(self, tok, place):
        """Of each token: training count, and log10 probability in its place."""
        words, inv = np.unique(tok, return_inverse=True)
        raw, p = self.word_tables(words)
        raw, p = raw[inv], p[inv]
        for n in range(2, self.m.order + 1):
            cols = ngram_columns(tok, place, n)
            ctx = chained(cols[:-1])
            if n == 2:
                u, at, inv = np.unique(ctx, return_index=True, return_inverse=True)
                stats = self.contexts(n, u, frequent([c[at] for c in cols[:-1]], self.hot))[inv]
            else:  # these hardly repeat in a few texts: finding out costs more than asking again
                stats = self.contexts(n, ctx, frequent(cols[:-1], self.hot))
            known = stats[:, 0] > 0
            total = np.maximum(stats[:, 0], 1)
            left = np.where(known, stats[:, 1:] @ np.array(self.m.levels[n - 1][4:]) / total, 1.0)
            hit = np.flatnonzero(known)
            c = np.zeros(len(ctx), np.int64)
            c[hit] = self.counts(str(n), V.chain(ctx[hit], tok[hit]), gram_shard([x[hit] for x in cols], self.hot, self.m.shards))
            p = self.discounted(c, n) / total + left * p
        return raw, np.log10(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """Score every text: ``id_col``, the columns in ``keep``, n_tokens,
    n_known, train_tokens, base_score, score, perplexity.

    ``score`` is the log10 probability of all words and the end; a null or
    empty text has its end only. Repeated rows are scored each.
    """
    df = docs.select(id_col, *keep, F.col(text_col).cast("string").alias("_text"))
    fields = [df.schema[c] for c in (id_col, *keep)]
    out = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
                        *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity"))])
    width = len(fields)

    def run(batches):
        import pyarrow as pa

        s = Searcher(model)
        unit = np.log10(model.tokens + 0.1 * (model.vocabulary + 1))
        for batch in batches:
            data, at = V.buffers(batch.column(width))
            for a, b in V.slices(at):
                tok, of, place = tokens(data[at[a]: at[b]], at[a: b + 1] - at[a])
                raw, logp = s.score(tok, place)
                n = np.bincount(of, minlength=b - a)
                full = V.row_sums(logp, of, b - a)
                cols = [n, V.row_sums(raw > 0, of, b - a).astype(np.int64), np.full(b - a, model.tokens),
                        V.row_sums(np.log10(raw + 0.1) - unit, of, b - a), full, 10 ** (-full / n)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *map(pa.array, cols)], names=[f.name for f in out])

    return df.mapInArrow(run, out)
