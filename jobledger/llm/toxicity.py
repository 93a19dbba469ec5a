"""Toxicity: boosted trees over dense features, calibrated by isotonic steps.

A lexicon of words and word beginnings is learned from labelled rows: those
whose mean density in toxic texts is well above that in clean ones. Features
of a text are lexicon densities (all, strongest, best window), how close hits
are to a second person, and rates of capitals, punctuation and obfuscation.
Trees are fitted to a bounded sample of labelled rows on the driver; a part
of that sample is kept for the calibration. Texts are scored whole, as arrays
over the bytes of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.llm import textvec as V
from jobledger.llm.store import share
from jobledger.plans.strategy import cut_lineage

SAMPLE_ROWS = 20_000  # labelled rows that are learned from
STEMS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that may be a lexicon entry
RATIO = 6.0  # how many times as dense in toxic texts an entry is at least
SUPPORT = 0.01  # share of the toxic rows that hold it at least
WINDOW = 20  # words
NEAR = 4  # words between a hit and a second person

# fixed values: second persons of English, German, French and Spanish
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "tus", "ti")
# fixed values: signs that stand for letters
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

NAMES = ("density", "weight", "strong", "window", "near_you", "second_person", "capitals", "shouted", "punctuation",
         "exclamation", "symbols", "digits_inside", "signs_inside", "repeats", "single_letters", "unmasked", "log_words")

_UNLEET = np.arange(256, dtype=np.uint8)
for _a, _b in LEET.items():
    _UNLEET[ord(_a)] = ord(_b)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = _UPPER.copy()
_ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = V.BARE & ~V.SPACE
_PUNCT[:33] = _PUNCT[127] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~_"]] = True


def units(data, starts, stops):
    """Hashes of each word (column 0) and of its beginnings (0: too short)."""
    out = np.zeros((1 + len(STEMS), len(starts)), np.uint64)
    sums = V.prefix(data)
    out[0] = V.hashes(data, starts, stops, sums)
    for j, k in enumerate(STEMS, 1):
        ok = np.flatnonzero(stops - starts > k)
        out[j, ok] = V.hashes(data, starts[ok], starts[ok] + k, sums)
    return out


def weights(lexicon, u):
    """The largest weight of each word's entries."""
    keys, w = lexicon
    out = np.zeros(u.shape[1])
    if not len(keys):
        return out
    first = np.zeros(1 << 16, bool)  # most hashes have a beginning that no entry has
    first[(keys >> np.uint64(48)).astype(np.int64)] = True
    for row in u:
        may = np.flatnonzero(first[(row >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, row[may]), len(keys) - 1)
        hit = keys[at] == row[may]
        out[may[hit]] = np.maximum(out[may[hit]], w[at[hit]])
    return out


def running(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.float64 if x.dtype.kind == "f" else np.int64)
    np.cumsum(x, out=out[1:])
    return out


def features(lexicon, you: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    n = len(at) - 1
    out = np.zeros((n, len(NAMES)))
    sizes = np.diff(at)

    def count(mask, shift=0):
        """Of each text, the marked places; ``shift``: its last ones left out."""
        total = running(mask)
        return (total[np.maximum(at[1:] - shift, at[:-1])] - total[at[:-1]]).astype(float)

    starts, stops, row = V.words(data, at, V.BARE)
    per = lambda x: V.row_sums(x, row, n)
    edge = np.searchsorted(row, np.arange(n + 1))  # words of text i: from edge[i] to edge[i + 1]
    words = np.diff(edge).astype(float)
    some = np.maximum(words, 1)
    u = units(data, starts, stops)
    w = weights(lexicon, u)
    hit = w > 0
    out[:, 0], out[:, 1] = per(hit) / some, per(w) / some
    np.maximum.at(out[:, 2], row[hit], w[hit])
    # the most weight in any run of WINDOW words; it ends with a hit
    total, seen = running(w), running(np.isin(u[0], you))
    k = np.flatnonzero(hit)
    first, last = edge[row[k]], edge[row[k] + 1]
    np.maximum.at(out[:, 3], row[k], total[k + 1] - total[np.maximum(k + 1 - WINDOW, first)])
    close = seen[np.minimum(k + 1 + NEAR, last)] > seen[np.maximum(k - NEAR, first)]
    out[:, 4] = np.bincount(row[k][close], minlength=n) / some
    out[:, 5] = (seen[edge[1:]] - seen[edge[:-1]]) / some
    alpha, upper, chars = _ALPHA[data], _UPPER[data], np.maximum(sizes, 1)
    caps = running(upper)
    loud = (caps[stops] - caps[starts] == stops - starts) & (stops - starts > 1)
    out[:, 6], out[:, 7] = count(upper) / np.maximum(count(alpha), 1), per(loud) / some
    punct = _PUNCT[data]
    out[:, 8], out[:, 9], out[:, 10] = count(punct) / chars, count(data == ord("!")) / chars, count(_SYMBOL[data]) / chars
    digit = running(_DIGIT[data])
    mixed = digit[stops] - digit[starts]
    out[:, 11] = per((mixed > 0) & (mixed < stops - starts)) / some
    if len(data) > 2:
        pad = np.zeros(2, bool)
        out[:, 12] = count(np.concatenate([alpha[:-2] & punct[1:-1] & alpha[2:], pad]), 2) / some
        out[:, 13] = count(np.concatenate([(data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & alpha[2:], pad]), 2) / some
    if len(starts):
        out[:, 14] = per((stops - starts == 1) & alpha[starts]) / some
    # words that are hits only once signs are read as letters
    plain = _UNLEET[data]
    s2, e2, r2 = V.words(plain, at, V.BARE)
    changed = running(plain != data)
    m = changed[e2] > changed[s2]
    s2, e2, r2 = s2[m], e2[m], r2[m]
    if len(s2):
        out[:, 15] = np.bincount(r2[weights(lexicon, units(plain, s2, e2)) > 0], minlength=n) / some
    out[:, 16] = np.log1p(words)
    return out


def second_person() -> np.ndarray:
    raw = " ".join(SECOND_PERSON).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, stops, _ = V.words(data, np.array([0, len(raw)]))
    return V.hashes(data, starts, stops)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """text, label and a hash of at most ``rows`` labelled texts, chosen by
    the hash of their id; equal texts count once. Repeated labels of an id:
    the largest."""
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna()
    own = own.groupBy("_id").agg(F.max("_label").alias("label")).withColumn("_h", F.pmod(F.xxhash64("_id"), F.lit(1 << 30)))
    n = own.count()
    chosen = own.filter(F.col("_h") < int(min(1.0, 1.1 * rows / max(n, 1)) * (1 << 30))).orderBy("_h", "_id").limit(rows)
    mine = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    joined = mine.join(F.broadcast(chosen), "_id")  # at most ``rows`` ids and labels
    once = joined.select("text", "label", F.xxhash64("text", F.lit("fold")).alias("h"))
    return cut_lineage(once.groupBy("h").agg(F.max("label").alias("label"), F.first("text").alias("text")))


def entries(data, at, label) -> pd.DataFrame:
    """Of a slice of texts: each entry's summed densities (d) and number of
    texts (n) by label."""
    starts, stops, row = V.words(data, at, V.BARE)
    size = np.bincount(row, minlength=len(label))
    u = units(data, starts, stops)
    of = np.broadcast_to(row.astype(np.uint64), u.shape)
    ok = u != 0
    unit, of = u[ok], of[ok]
    _, first, count = np.unique(V.chain(unit, of), return_index=True, return_counts=True)
    of = of[first].astype(np.int64)
    rows = pd.DataFrame({"u": unit[first].view(np.int64), "label": label[of].astype(np.int32), "d": count / np.maximum(size[of], 1)})
    return rows.groupby(["u", "label"], as_index=False).agg(d=("d", "sum"), n=("d", "size"))


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of entries, sorted, and the logarithms of their ratios."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = V.buffers(batch.column(0))
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in V.slices(at, V.SLICE // 4):
                yield pa.RecordBatch.from_pandas(entries(data[at[a]: at[b]], at[a: b + 1] - at[a], label[a:b]), preserve_index=False)

    bad = F.col("label") == 1
    stats = rows.select("text", "label").mapInArrow(run, "u long, label int, d double, n long").groupBy("u").agg(
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(bad, F.col("d")).otherwise(0.0)).alias("dt"), F.sum(F.when(bad, 0.0).otherwise(F.col("d"))).alias("dc"))
    ratio = (F.col("dt") / max(toxic, 1)) / (F.col("dc") / max(clean, 1) + 1e-6)
    kept = stats.filter(F.col("n") >= max(3, SUPPORT * toxic)).select("u", ratio.alias("r")).filter(F.col("r") >= RATIO).collect()
    keys = np.array([r.u for r in kept], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.minimum(np.log(np.array([r.r for r in kept], float)), 6.0)[order]


@dataclass
class Trees:
    """Boosted trees on binned features, and the steps of the calibration."""

    edges: list
    start: float
    trees: list  # (feature, bin, value) arrays of complete trees
    x: np.ndarray
    y: np.ndarray

    def margin(self, f: np.ndarray) -> np.ndarray:
        b = binned(f, self.edges)
        out = np.full(len(f), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(f), np.int64)
            for _ in range(int(np.log2(len(feature) + 1))):
                node = 2 * node + 1 + (b[np.arange(len(f)), feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def score(self, f: np.ndarray) -> np.ndarray:
        m = self.margin(f)
        # a hundredth of the margin's own probability keeps an order within a step
        return 0.99 * np.interp(m, self.x, self.y) + 0.01 / (1 + np.exp(-m))


def binned(f: np.ndarray, edges: list) -> np.ndarray:
    return np.stack([np.searchsorted(e, f[:, j], side="left") for j, e in enumerate(edges)], 1)


def boost(f: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64) -> Trees:
    """Newton boosting of the logistic loss with complete trees."""
    edges = [np.unique(np.quantile(np.concatenate([c[c != 0], [0.0]]), np.linspace(0, 1, bins))) if len(f) else np.zeros(1) for c in f.T]
    b = binned(f, edges)
    p0 = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    start, trees = float(np.log(p0 / (1 - p0))), []
    m = np.full(len(f), start)
    rounds = rounds if 0 < y.sum() < len(y) else 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = y - p, p * (1 - p)
        inner, leaves = (1 << depth) - 1, 1 << depth
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, bins + 1), np.zeros(len(f), np.int64)
        for level in range(depth):
            width = 1 << level
            at = node - (width - 1)
            best = np.full(width, 1e-9)
            for j in range(f.shape[1]):
                k = len(edges[j]) + 1
                gs = np.bincount(at * k + b[:, j], g, width * k).reshape(width, k).cumsum(1)
                hs = np.bincount(at * k + b[:, j], h, width * k).reshape(width, k).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 1) | (ht - hs < 1)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                for n in np.flatnonzero(value > best):
                    best[n], feature[width - 1 + n], cut[width - 1 + n] = value[n], j, top[n]
            node = 2 * node + 1 + (b[np.arange(len(f)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        trees.append((feature, cut, value))
        m += value[leaf]
    return Trees(edges, start, trees, np.array([0.0]), np.array([p0]))


def isotonic(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; margins and values of the steps' ends. Each
    step is drawn towards its neighbours by one row of each label."""
    order = np.argsort(m, kind="stable")
    blocks: list = []
    for x, v in zip(m[order], y[order]):
        blocks.append([v, 1, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], hi]
    x = np.array([v for b in blocks for v in (b[2], b[3])])
    value = np.maximum.accumulate([(b[0] + 0.01) / (b[1] + 0.02) for b in blocks for _ in (0, 1)])
    return x, value


@dataclass
class Model:
    lexicon: tuple
    you: np.ndarray
    trees: Trees


def _table(rows: DataFrame, lexicon, you) -> pd.DataFrame:
    """Features, label and h of the sampled rows, on the driver."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = V.buffers(batch.column(0))
            for a, b in V.slices(at):
                f = features(lexicon, you, data[at[a]: at[b]], at[a: b + 1] - at[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in f.T), part.column(1), part.column(2)], names=[*NAMES, "label", "h"])

    return rows.select("text", "label", "h").mapInArrow(run, ", ".join(f"{n} double" for n in NAMES) + ", label int, h long").toPandas()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows of ``docs`` that ``labels`` marks 0 or 1. Without
    labels of both kinds the model gives one score to all."""
    some = labelled(docs, labels, id_col, text_col, label_col, rows)
    kinds = {r.label: r.n for r in some.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    lexicon, you = learn_lexicon(some, kinds.get(1, 0), kinds.get(0, 0)), second_person()
    t = _table(some, lexicon, you).sort_values("h")
    f, y = t[list(NAMES)].to_numpy(float), t["label"].to_numpy(float)
    held = (t["h"].to_numpy() % 4) == 0
    if y[held].sum() < 5 or (1 - y[held]).sum() < 5:
        held[:] = True
        trees = boost(f, y)
    else:
        trees = boost(f[~held], y[~held])
    if len(y):
        trees.x, trees.y = isotonic(trees.margin(f[held]), y[held])
    return Model(lexicon, you, trees)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """``keep`` columns, score (0 to 1) and predicted (1 from ``threshold``).
    A null text is scored as an empty one."""
    df = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    fields = [df.schema[c] for c in keep]
    out = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = share(df.sparkSession, model)  # bounded by the sample
    width = len(fields)

    def run(batches):
        import pyarrow as pa

        m = shared()
        for batch in batches:
            data, at = V.buffers(batch.column(width))
            for a, b in V.slices(at):
                s = m.trees.score(features(m.lexicon, m.you, data[at[a]: at[b]], at[a: b + 1] - at[a]))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[f.name for f in out])

    return df.mapInArrow(run, out)
