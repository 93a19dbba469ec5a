"""SimHash near-duplicates: fingerprints linked through vantage-point trees.

A text's fingerprint has a bit set where more than half of its word shingles'
hashes have it. Equal fingerprints are joined first, with one row each. Two
fingerprints that differ in at most d bits differ in at most d // blocks bits
of one of ``blocks`` equal parts, so each part gets a vantage-point tree with
that radius: a node sends a fingerprint inward or outward by its Hamming
distance to the vantage point, and by the triangle bound also to the other
side where the distance is within the radius of the border. The trees' leaves
are the shards: each fingerprint has one of its own, and queries those whose
border it is near as a visitor. A shard's own fingerprints are compared
exactly with all that are there.

The trees come from a bounded sample; they steer the work and never the
result. A shard well above the mean is cut into chunks that meet in pairs.
A task reports a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.llm import textvec as V
from jobledger.llm.components import components
from jobledger.plans.strategy import cut_lineage

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42  # of XXH64
BITS = 64
SAMPLE = 16_384  # fingerprints that shape the trees
LEAF = 512  # aim for a shard
DEEPEST = 20
CHUNK = 1024  # least size of a chunk of a large shard


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of the ``size``-word shingles of lower-cased ``text``, repeats
    included; fewer words: the whole sequence; none: 0."""
    import xxhash

    words = WORDS.findall(text)
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(size))) if len(words) >= size else [words]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(b" ".join(g), SEED) for g in grams], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k: k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (long: the fingerprint's 64 bits); null text: 0."""
    df = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = V.buffers(batch.column(1))
            raw = [V.LOWER[data[a:b]].tobytes() for a, b in zip(at[:-1], at[1:])]
            fp = np.array([fingerprint(t, size) for t in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=[id_col, "fp"])

    return df.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int64)


@dataclass
class Tree:
    """A complete vantage-point tree over one part of the bits. Node n has
    the children 2n + 1 (inside) and 2n + 2; ``border``: largest distance
    inside."""

    mask: int
    radius: int
    depth: int
    point: np.ndarray
    border: np.ndarray

    def shards(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``x``, leaf, whether it is the row's own) for all leaves
        within the radius of each."""
        x = x & np.uint64(self.mask)
        row, node, own = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
        for _ in range(self.depth):
            d, edge = distance(x[row], self.point[node]), self.border[node]
            inward, outward, inside = d - self.radius <= edge, d + self.radius > edge, d <= edge
            row = np.concatenate([row[inward], row[outward]])
            own = np.concatenate([(own & inside)[inward], (own & ~inside)[outward]])
            node = np.concatenate([2 * node[inward] + 1, 2 * node[outward] + 2])
        return row, node - ((1 << self.depth) - 1), own


def plant(sample: np.ndarray, mask: int, radius: int, depth: int) -> Tree:
    """A tree whose borders are medians of the sample's distances. Nodes that
    the sample does not reach split at half of the part's bits."""
    x = np.unique(sample & np.uint64(mask))
    nodes = (1 << depth) - 1
    rng = np.random.default_rng(7)
    point = (rng.integers(0, 1 << 63, nodes, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, nodes, dtype=np.uint64)) & np.uint64(mask)
    border = np.full(nodes, mask.bit_count() // 2, np.int64)
    parts = {0: x}
    for n in range(nodes):
        own = parts.pop(n, None)
        if own is None or len(own) < 2:
            continue
        # of a few candidates the one that splits the sample most evenly
        best = None
        for p in own[np.linspace(0, len(own) - 1, min(8, len(own))).astype(int)]:
            d = distance(own, p)
            edge = int(np.median(d))
            edge = edge - 1 if (d <= edge).all() else edge
            off = abs(2 * int((d <= edge).sum()) - len(own))
            if best is None or off < best[0]:
                best = (off, p, edge, d)
        _, point[n], border[n], d = best
        if 2 * n + 1 < nodes:
            parts[2 * n + 1], parts[2 * n + 2] = own[d <= border[n]], own[d > border[n]]
    return Tree(mask, radius, depth, point, border)


def masks(blocks: int) -> list[int]:
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:])]


def forest(x: np.ndarray, most: int, own: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Places of links that join ``x`` (distinct) as all links within ``most``
    bits do between those of ``own`` (none given: all) and any: one fewer than
    the members of each group."""
    near = np.zeros(len(x), bool)
    mine = np.arange(len(x)) if own is None else np.flatnonzero(own)
    step = max(1, (1 << 21) // max(len(x), 1))
    for a in range(0, len(mine), step):
        some = mine[a: a + step]
        hit = distance(x[some, None], x[None, :]) <= most
        hit[np.arange(len(some)), some] = False
        near[some] |= hit.any(1)
        near |= hit.any(0)
    left, out = np.flatnonzero(near), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:64], front[64:]
            hit = distance(x[some][:, None], x[left][None, :]) <= most
            got = hit.any(0)
            out += zip(some[hit.argmax(0)[got]].tolist(), left[got].tolist())
            front, left = np.concatenate([front, left[got]]), left[~got]
    return out


def links(prints: DataFrame, most: int = 3, blocks: int = 2) -> DataFrame:
    """Links (a, b) between the distinct values of the long column ``fp``
    that differ in at most ``most`` bits: a spanning forest of each shard."""
    spark = prints.sparkSession
    n = prints.count()
    sample = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(SAMPLE / max(n, 1) * (1 << 30)) + 1).limit(2 * SAMPLE)
    sample = np.array([r.fp for r in sample.select("fp").collect()], np.int64).view(np.uint64)
    depth = int(min(DEEPEST, max(0, np.ceil(np.log2(max(n, 1) / LEAF)))))
    trees = [plant(sample, m, most // blocks, depth) for m in masks(blocks)]
    shards = blocks << depth

    def place(fp: np.ndarray):
        for k, tree in enumerate(trees):
            row, leaf, own = tree.shards(fp)
            yield row, leaf + (k << depth), own

    def sizes(batches):
        total = np.zeros(shards, np.int64)
        for pdf in batches:
            for _, shard, _ in place(pdf["fp"].to_numpy().view(np.uint64)):
                total += np.bincount(shard, minlength=shards)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"shard": at, "n": total[at]})

    counts = prints.select("fp").mapInPandas(sizes, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    rows, used = counts.agg(F.sum("n"), F.count("n")).first()
    chunk = max(CHUNK, 2 * (rows or 0) // max(used, 1))
    large = {r.shard: -(-r.n // chunk) for r in counts.filter(F.col("n") > chunk).collect()}  # at most rows / chunk of them

    def cells(batches):
        keys, cut = np.array(sorted(large), np.int64), np.array([large[k] for k in sorted(large)], np.int64)
        for pdf in batches:
            fp = pdf["fp"].to_numpy()
            for row, shard, own in place(fp.view(np.uint64)):
                at = np.minimum(np.searchsorted(keys, shard), max(len(keys) - 1, 0))
                hot = keys[at] == shard if len(keys) else np.zeros(len(shard), bool)
                yield pd.DataFrame({"shard": shard[~hot], "i": 0, "j": 0, "fp": fp[row[~hot]], "own": own[~hot]})
                for s in np.unique(shard[hot]):
                    there, c = shard == s, large[int(s)]
                    some = fp[row[there]]
                    mine = (V.mix(some.view(np.uint64)) % np.uint64(c)).astype(np.int64)
                    for other in range(c):
                        yield pd.DataFrame({"shard": s, "i": np.minimum(mine, other), "j": np.maximum(mine, other), "fp": some, "own": own[there]})

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        found = np.array(forest(fp.view(np.uint64), most, pdf["own"].to_numpy()), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fp[found[:, 0]], "b": fp[found[:, 1]]})

    return (prints.select("fp").mapInPandas(cells, "shard long, i long, j long, fp long, own boolean")
            .groupBy("shard", "i", "j").applyInPandas(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                    most: int = 3, blocks: int = 2) -> DataFrame:
    """Per row of ``docs``: ``id_col``, fingerprint (16 hex digits),
    component_id: the smallest id that links of at most ``most`` differing
    bits reach. Texts without words share the fingerprint 0 and are linked.
    Null ids take part; they are a component_id only where all are null."""
    own = cut_lineage(fingerprints(docs, id_col, text_col, size))
    prints = cut_lineage(own.groupBy("fp").agg(F.min(id_col).alias("low")))
    roots = components(links(prints, most, blocks))
    member = prints.join(roots, prints.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    group = member.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return own.join(group, own.fp == group._fp).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
