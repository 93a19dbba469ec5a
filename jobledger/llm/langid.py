"""Language ID: prediction by partial matching over bytes.

For each language a variable-order byte context tree is learned from a
bounded sample of labelled texts and then frozen. A byte's code length in a
language is that of escape method C: from the longest context that the tree
holds, a byte seen there costs -log2(count / (total + kinds)), any other
costs the escape -log2(kinds / (total + kinds)) and then its price in the
next shorter context; after the empty context comes a flat 1/256. A text's
language is the one with the shortest code.

All trees lie in one table of contexts and one of context-and-byte grams, so
a batch of texts is priced with a few array look-ups. Texts are priced whole,
in slices of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.llm import textvec as V
from jobledger.llm.store import share as share_model

ORDER = 4  # longest context in bytes
TRAIN_BYTES = 1_000_000  # per language; texts are drawn by hash until about so much
BLOCK = 1 << 14  # bytes of a text that are drawn together
MIN_COUNT = 2  # a context is kept if seen so often; its prefixes always are
UNDETERMINED = "und"


def keys_at(data: np.ndarray, back: np.ndarray, length: int) -> np.ndarray:
    """The last ``length`` bytes before and at each place as one exact
    integer; ``back``: bytes of the text before that place (fewer: zeros)."""
    key = data.astype(np.uint64) + np.uint64(1)
    out = key.copy()
    for k in range(1, length):
        moved = np.zeros(len(key), np.uint64)
        moved[k:] = key[:-k] if len(key) > k else key[:0]
        moved[back < k] = 0
        out |= moved << np.uint64(9 * k)
    return out


class Table:
    """Open addressing over exact integer keys; the tag keeps orders apart."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.slot_key = np.zeros(1 << self.bits, np.uint64)
        self.slot_row = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        at = self.hash(keys)
        while len(left):
            free = self.slot_row[at] < 0
            # of several keys for one free slot, the first gets it
            slots, first = np.unique(np.where(free, at, -1), return_index=True)
            first = first[slots >= 0]
            self.slot_key[at[first]] = keys[left[first]]
            self.slot_row[at[first]] = left[first]
            stay = np.ones(len(left), bool)
            stay[first] = False
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)

    def hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        at = self.hash(keys)
        out = self.slot_row[at].copy()
        open_ = np.flatnonzero((out >= 0) & (self.slot_key[at] != keys))
        at = at[open_]
        while len(open_):
            at = (at + 1) & ((1 << self.bits) - 1)
            got = self.slot_row[at]
            out[open_] = got
            go = (got >= 0) & (self.slot_key[at] != keys[open_])
            open_, at = open_[go], at[go]
        return out


def tagged(key: np.ndarray, length: int) -> np.ndarray:
    return key | np.uint64(length << 58)


@dataclass
class Model:
    """Frozen trees. ``price``: bits of each gram by language; ``escape``: of
    each context by language, 0 where the language does not know it."""

    languages: list
    order: int
    grams: Table
    price: np.ndarray
    contexts: Table
    escape: np.ndarray


def fit(texts: dict, order: int = ORDER, min_count: int = MIN_COUNT) -> Model:
    """``texts``: language -> list of byte strings."""
    languages = sorted(texts)
    trees = []  # by language: for each order, context -> (total, kinds) and gram -> count
    for lang in languages:
        data = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(t, np.uint8) for t in texts[lang])])
        sizes = np.array([len(t) for t in texts[lang]], np.int64)
        back = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        levels = []
        for n in range(order + 1):
            ok = back >= n
            gram, count = np.unique(keys_at(data, back, n + 1)[ok], return_counts=True)
            # the context is the gram without its last byte
            ctx = gram >> np.uint64(9)
            names, at = np.unique(ctx, return_inverse=True)
            total, kinds = np.bincount(at, count, len(names)), np.bincount(at, minlength=len(names))
            keep = (total >= min_count) | (n <= 1)
            levels.append((gram[keep[at]], count[keep[at]], names[keep], total[keep], kinds[keep]))
        trees.append(levels)
    gram_keys, prices, ctx_keys, escapes = [], [], [], []
    lower = None  # prices of the order below: keys and matrix
    for n in range(order + 1):
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t[n][0] for t in trees)]))
        names = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t[n][2] for t in trees)]))
        price, escape = np.zeros((len(keys), len(languages))), np.zeros((len(names), len(languages)))
        if lower is not None:
            # every suffix of a gram seen is a gram seen, unless pruned: then by the escapes below
            price += lower(keys & np.uint64((1 << (9 * n)) - 1), n - 1)
        else:
            price += 8.0
        for l, t in enumerate(trees):
            gram, count, name, total, kinds = t[n]
            at = np.searchsorted(names, name)
            escape[at, l] = -np.log2(kinds / (total + kinds))
            ctx = keys >> np.uint64(9)
            i = np.minimum(np.searchsorted(names, ctx), max(len(names) - 1, 0))
            if len(names):
                price[:, l] += np.where(names[i] == ctx, escape[i, l], 0.0)
            own = np.searchsorted(keys, gram)
            j = np.searchsorted(name, gram >> np.uint64(9))
            price[own, l] = -np.log2(count / (total[j] + kinds[j]))
        gram_keys.append(tagged(keys, n))
        prices.append(price)
        ctx_keys.append(tagged(names, n))
        escapes.append(escape)

        def lower(q, m, ks=list(gram_keys), ps=list(prices), ns=list(ctx_keys), es=list(escapes)):
            out = np.zeros((len(q), len(languages)))
            todo = np.arange(len(q))
            for k in range(m, -1, -1):
                key = tagged(q[todo] & np.uint64((1 << (9 * (k + 1))) - 1), k)
                i = np.minimum(np.searchsorted(ks[k], key), max(len(ks[k]) - 1, 0))
                hit = ks[k][i] == key if len(ks[k]) else np.zeros(len(key), bool)
                out[todo[hit]] += ps[k][i[hit]]
                todo, key = todo[~hit], key[~hit]
                c = tagged((key & np.uint64((1 << 58) - 1)) >> np.uint64(9), k)
                i = np.minimum(np.searchsorted(ns[k], c), max(len(ns[k]) - 1, 0))
                if len(ns[k]) and len(todo):
                    there = ns[k][i] == c
                    out[todo[there]] += es[k][i[there]]
            out[todo] += 8.0
            return out

    as32 = lambda parts: np.concatenate(parts).astype(np.float32)
    return Model(languages, order, Table(np.concatenate(gram_keys)), as32(prices), Table(np.concatenate(ctx_keys)), as32(escapes))


def code_lengths(model: Model, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits of each row of ``data`` in each language."""
    out = np.zeros((len(at) - 1, len(model.languages)))
    price = np.concatenate([model.price, np.zeros((1, len(model.languages)), np.float32)])  # its last row: not priced yet
    for (first, a), b in pieces(at):
        lo = max(a - model.order, int(at[first]))  # so many bytes before, for the first contexts
        last = int(np.searchsorted(at, b, side="left"))
        edges = np.clip(at[first: last + 1], lo, b)  # rows first to last - 1, cut to this piece
        sizes = np.diff(edges)
        back = np.arange(lo, b) - np.repeat(at[first:last], sizes)
        own = slice(a - lo, None)
        full, back = keys_at(data[lo:b], back, model.order + 1)[own], back[own]
        got = model.grams.rows(tagged(full, model.order))
        got[back < model.order] = -1
        cost = price[got]
        todo = np.flatnonzero(got < 0)
        for k in range(model.order, -1, -1):
            may = todo[back[todo] >= k]
            key = full[may] & np.uint64((1 << (9 * (k + 1))) - 1)
            got = model.grams.rows(tagged(key, k))
            hit = got >= 0
            cost[may[hit]] += model.price[got[hit]]
            miss = may[~hit]
            ctx = model.contexts.rows(tagged(key[~hit] >> np.uint64(9), k))
            there = ctx >= 0
            cost[miss[there]] += model.escape[ctx[there]]
            todo = np.concatenate([miss, todo[back[todo] < k]])
        cost[todo] += 8.0
        starts = np.maximum(edges[:-1], a) - a
        full_rows = np.flatnonzero(np.diff(np.append(starts, b - a)))
        out[first + full_rows] += np.add.reduceat(cost, starts[full_rows], axis=0, dtype=np.float64)
    return out


def pieces(at: np.ndarray, size: int = 1 << 18):
    """((row, place), end) of runs of bytes of bounded size, across rows and
    within long ones."""
    end = int(at[-1])
    for p in range(int(at[0]), end, size):
        yield (int(np.searchsorted(at, p, side="right")) - 1, p), min(p + size, end)


def sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, train_bytes: int = TRAIN_BYTES) -> dict:
    """About ``train_bytes`` of text per language, brought to the driver, which
    the bound allows: blocks of texts in the order of a hash of id, text and
    place. A text longer than ``BLOCK`` is several blocks, so that no language
    of few, long texts drops out and no long text passes the bound."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    block = max(256, min(BLOCK, train_bytes // 16))
    # some more than the bound, so that the draw never falls short of it
    share = {k: min(1.0, (train_bytes + 64 * block) / max(v, 1)) for k, v in sizes.items()}

    def draw(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            langs, marks, blocks = [], [], []
            for lang, text, h in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                a, k = 0, 0
                while a < len(data) or k == 0:
                    b = min(a + block, len(data))
                    while b < len(data) and data[b] & 0xC0 == 0x80:
                        b += 1
                    mark = xxhash.xxh64_intdigest(h.to_bytes(8, "little", signed=True), k) >> 2
                    if mark < share[lang] * (1 << 62):
                        langs.append(lang)
                        marks.append(mark)
                        blocks.append(data[a:b])
                    a, k = b, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(marks, pa.int64()), pa.array(blocks, pa.binary())], names=["lang", "mark", "block"])

    drawn = rows.mapInArrow(draw, "lang string, mark long, block binary")
    before = F.sum(F.octet_length("block")).over(Window.partitionBy("lang").orderBy("mark", "block").rowsBetween(Window.unboundedPreceding, -1))
    kept = drawn.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < train_bytes)
    texts: dict = {}
    for r in kept.select("lang", "block").collect():
        texts.setdefault(r.lang, []).append(bytes(r.block))
    return {k: sorted(v) for k, v in texts.items()}


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Model:
    """Learn a tree per language from the non-null ``lang_col`` of ``docs``."""
    return fit(sample(docs, text_col, lang_col, id_col, train_bytes), order)


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score, bits_per_byte.

    ``und`` with score 0 where the text is null or has no letter, or where no
    language was learned. ``score`` is the chosen language's share of
    probability, from the mean code lengths of up to 200 bytes, so that it
    does not depend on a text's length beyond that. Ties go to the name that
    sorts first.
    """
    text = F.col(text_col).cast("string")
    df = docs.select(*keep, F.when(text.rlike(r"\p{L}"), text).alias("_text"))
    fields = [df.schema[c] for c in keep]
    out = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    shared = share_model(df.sparkSession, model)  # bounded by the training bytes
    width = len(fields)

    def run(batches):
        import pyarrow as pa

        m = shared()
        for batch in batches:
            data, at = V.buffers(batch.column(width))
            n = at[1:] - at[:-1]
            if m.languages:
                bits = code_lengths(m, data, at)
                best = bits.argmin(1)
                low = bits[np.arange(len(n)), best]
                odds = np.exp2((low[:, None] - bits) * (np.minimum(n, 200) / np.maximum(n, 1))[:, None]).sum(1)
                ok = n > 0
                name = [m.languages[i] if k else UNDETERMINED for i, k in zip(best, ok)]
                share, rate = np.where(ok, 1 / odds, 0.0), np.where(ok, low / np.maximum(n, 1), np.nan)
            else:
                name, share, rate = [UNDETERMINED] * len(n), np.zeros(len(n)), np.full(len(n), np.nan)
            cols = [pa.array(name, pa.string()), pa.array(share), pa.array(rate, mask=np.isnan(rate))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *cols], names=[f.name for f in out])

    return df.mapInArrow(run, out)
