"""Collocations: phrases whose words stand together more often than apart.

Two passes over whole texts find every phrase of one to ``most`` words that
occurs at least ``least`` times in its language. The first deals phrase hashes
to hash partitions and merges, in each, Misra-Gries summaries whose capacity
exceeds the partition's mass divided by ``least``: no frequent phrase can be
lost, whatever the order of the merges. What survives becomes a filter of
bounded size. The second pass counts, as text, the phrases that the filter
lets through; rare phrases that slip through fall to the exact counts.

A text longer than ``SLICE`` bytes is cut between words into windows that look
ahead by ``most`` - 1 words, so memory is bounded by the longest word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm import textvec
from jobledger.llm.store import share
from jobledger.plans.strategy import cut_lineage

SLICE = 1 << 20  # bytes of text whose phrases are in memory at a time
FLUSH = 3_000_000  # phrases that a task adds up before it sends them on
MERGE = 1_000_000  # counts that a partition's summary takes at a time
PART_BYTES = 8 << 20  # text a hash partition
FILTER_BITS = 1 << 29  # all partitions' filters together
KEY_BITS = 40  # of a phrase's hash, within its partition
UNDETERMINED = "und"

# bytes that end a piece, and those that end a word
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
GAPS = ENDS.copy()
GAPS[list(b" \t")] = True


def windows(data: np.ndarray, at: np.ndarray, ahead: int, size: int = SLICE):
    """(row, row offsets, end, stop) of runs of whole rows, or of parts of a
    longer row: phrases that begin before ``end`` lie before ``stop``. Offsets,
    end and stop are places in ``data``."""
    for i, j in textvec.slices(at, size):
        a, last = int(at[i]), int(at[j])
        if last - a <= size:
            yield i, at[i: j + 1], last, last
            continue
        while a < last:
            end = _gap(data, min(a + size, last), last)
            stop = end
            for _ in range(ahead):
                stop = _gap(data, _word(data, stop, last), last)
            yield i, np.array([a, stop]), end, stop
            a = end


def _seek(hit: np.ndarray, data: np.ndarray, a: int, last: int) -> int:
    """The first place from ``a`` whose byte is in ``hit``, else ``last``."""
    step = 256
    while a < last:
        found = hit[data[a: min(a + step, last)]]
        if found.any():
            return a + int(found.argmax())
        a, step = a + step, step * 2
    return last


def _gap(data, a, last):
    return _seek(GAPS, data, a, last)


def _word(data, a, last):
    return _seek(~GAPS, data, a, last)


def occurrences(data: np.ndarray, rows: np.ndarray, end: int, seed: np.ndarray, most: int):
    """The phrases of a window: for each number of words, their hashes, their
    first words' places among the window's words, and all words' starts, stops
    and rows. ``rows``: row offsets; ``seed``: a hash for each row's language.
    Phrases lie within a piece and begin before ``end``."""
    base, stop = int(rows[0]), int(rows[-1])
    part = data[base:stop]
    starts, stops, row = textvec.words(part, rows - base, GAPS)
    word = textvec.hashes(part, starts, stops)
    piece = np.cumsum(ENDS[part], dtype=np.int64)[starts] if len(part) else starts
    joined = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    first = np.arange(int(np.searchsorted(starts, end - base)))
    value = textvec.chain(seed[row[first]], word[first])
    out = [(value, first)]
    for k in range(1, most):
        on = first + k < len(word)
        on[on] = joined[first[on] + k - 1]
        first, value = first[on], value[on]
        value = textvec.chain(value, word[first + k])
        out.append((value, first))
    return out, starts + base, stops + base, row


def seeds(langs) -> np.ndarray:
    """A 64-bit hash for each language of an Arrow column without nulls."""
    import xxhash

    codes = langs.dictionary_encode()
    each = np.array([xxhash.xxh64_intdigest(s.as_py().encode(), 7) for s in codes.dictionary], np.uint64)
    return each[codes.indices.to_numpy(zero_copy_only=False)]


def part_of(value: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition of each hash: ascending with the hash."""
    return ((value >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def spots(key: np.ndarray, bits) -> list[np.ndarray]:
    """Three places of each key in a filter of ``bits`` bits."""
    a = textvec.mix(key + np.uint64(0x9E3779B97F4A7C15))
    b = (a >> np.uint64(32)) | np.uint64(1)
    a = a & np.uint64(0xFFFFFFFF)
    return [(a + np.uint64(i) * b) % bits for i in range(3)]


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters. ``lost``: the
    most that any count falls short."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counts; if there are too many counters, take the largest that
        must go from each, so that at most ``capacity`` are left."""
        order = np.argsort(keys := np.concatenate([self.keys, keys]), kind="stable")
        keys, counts = keys[order], np.concatenate([self.counts, counts])[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[new], np.add.reduceat(counts, new) if len(new) else counts
        if len(keys) > self.capacity:
            over = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            keys, counts = keys[counts > over], counts[counts > over] - over
            self.lost += int(over)
        self.keys, self.counts = keys, counts


def summaries(docs: DataFrame, parts: int, most: int) -> DataFrame:
    """A task's added-up phrases by hash partition: ``part``, ``keys`` (five
    bytes each) and ``counts`` (one byte each; larger counts repeat the key).
    ``docs``: columns lang, text."""

    def run(batches):
        import pyarrow as pa

        held, n = [], 0

        def send():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            again = (count + 254) // 255
            value, size = np.repeat(value, again), np.full(int(again.sum()), 255, np.uint8)
            size[np.cumsum(again) - 1] = count - 255 * (again - 1)
            part = part_of(value, parts)
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            key = (value & np.uint64((1 << KEY_BITS) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            ends = np.append(cut, len(value)).astype(np.int32)

            def column(width, body):
                return pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends * np.int32(width)), pa.py_buffer(np.ascontiguousarray(body))])

            return pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int32)), column(5, key), column(1, size)], names=["part", "keys", "counts"])

        for batch in batches:
            seed = seeds(batch.column(0))
            data, at = textvec.buffers(batch.column(1))
            for row, rows, end, _ in windows(data, at, most - 1):
                for value, _ in occurrences(data, rows, end, seed[row:], most)[0]:
                    held.append(value)
                    n += len(value)
                if n >= FLUSH:
                    yield send()
                    held, n = [], 0
        if n:
            yield send()

    return docs.mapInArrow(run, "part int, keys binary, counts binary")


def survivors(sent: DataFrame, parts: int, least: int) -> DataFrame:
    """Merge each hash partition's summaries: ``part``, ``bits`` and the
    ``filter`` of the keys that may occur ``least`` times."""
    ceiling = max(64, FILTER_BITS // parts)

    def merge(table):
        import pyarrow as pa

        part = table.column(0)[0].as_py()
        rows = range(table.num_rows)
        mass = sum(int(np.frombuffer(c.as_buffer(), np.uint8).sum(dtype=np.int64)) for c in table.column(2))
        held, n, got = [], 0, Summary(mass // least + 1)
        for i in rows:
            body = np.frombuffer(table.column(1)[i].as_buffer(), np.uint8).reshape(-1, 5)
            wide = np.zeros((len(body), 8), np.uint8)
            wide[:, :5] = body
            held.append((wide.reshape(-1).view("<u8"), np.frombuffer(table.column(2)[i].as_buffer(), np.uint8).astype(np.int64)))
            n += len(body)
            if n >= MERGE or i == rows[-1]:
                got.merge(*(np.concatenate(c) for c in zip(*held)))
                held, n = [], 0
        keys = got.keys[got.counts + got.lost >= least]
        bits = min(max(64, 16 * len(keys)), ceiling)
        field = np.zeros(bits, bool)
        for spot in spots(keys, np.uint64(bits)):
            field[spot] = True
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([bits], pa.int64()),
                         "filter": pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary())})

    return sent.groupBy("part").applyInArrow(merge, "part int, bits long, filter binary")


class Filter:
    """All partitions' filters in one array: at most ``FILTER_BITS`` bits and
    64 for each partition."""

    def __init__(self, rows, parts: int):
        self.parts = parts
        self.bits, self.first = np.full(parts, 8, np.uint64), np.zeros(parts, np.uint64)
        body, at = [b"\0"], 1
        for row in rows:
            self.bits[row.part], self.first[row.part] = row.bits, at * 8
            body.append(bytes(row.filter))
            at += len(row.filter)
        self.body = np.frombuffer(b"".join(body), np.uint8)

    def __call__(self, value: np.ndarray) -> np.ndarray:
        part = part_of(value, self.parts)
        first, ok = self.first[part], np.ones(len(value), bool)
        for spot in spots(value & np.uint64((1 << KEY_BITS) - 1), self.bits[part]):
            place = first + spot
            ok &= (self.body[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok


def joined(data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """Arrow strings of the words of each row of ``starts``, ``stops`` (one
    column a word), with one space between."""
    import pyarrow as pa

    n, k = starts.shape
    a, b = np.zeros((n, 2 * k - 1), np.int64), np.zeros((n, 2 * k - 1), np.int64)
    a[:, 0::2], b[:, 0::2] = starts, stops
    b[:, 1::2] = 1
    size = (b - a).reshape(-1)
    ends = np.cumsum(size)
    body = np.arange(int(ends[-1]) if n else 0) + np.repeat(a.reshape(-1) - ends + size, size)
    out = textvec.LOWER[data[body]]
    ends = ends.reshape(n, 2 * k - 1)
    out[ends[:, 1::2].ravel() - 1] = 32
    at = np.concatenate([[0], ends[:, -1]])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out)])


def exact(docs: DataFrame, held: Filter, most: int, least: int) -> DataFrame:
    """The second pass: ``lang``, ``size`` (words), ``phrase`` and ``f`` of each
    phrase that occurs ``least`` times, and of each language's words in all
    (size 0, phrase empty). Within a window, phrases are told apart by 64-bit
    hashes, between windows by their text."""
    spark = docs.sparkSession
    given = share(spark, held)

    def run(batches):
        import pyarrow as pa

        allowed = given()
        for batch in batches:
            seed, langs = seeds(batch.column(0)), batch.column(0)
            data, at = textvec.buffers(batch.column(1))
            for row, rows, end, _ in windows(data, at, most - 1):
                found, starts, stops, at_row = occurrences(data, rows, end, seed[row:], most)
                for k, (value, first) in enumerate(found, 1):
                    if k == 1:
                        total = np.bincount(at_row[first], minlength=1)
                        some = np.flatnonzero(total)
                        yield batch_of(pa, langs.take(pa.array(some + row)), 0, pa.array([""] * len(some), pa.large_string()), total[some])
                    on = allowed(value)
                    value, first = value[on], first[on]
                    value, place, count = np.unique(value, return_index=True, return_counts=True)
                    first = first[place]
                    words = first[:, None] + np.arange(k)
                    yield batch_of(pa, langs.take(pa.array(at_row[first] + row)), k, joined(data, starts[words], stops[words]), count)

    def batch_of(pa, lang, size, phrase, count):
        return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(lang), size, np.int32)), phrase.cast(pa.string()), pa.array(count.astype(np.int64))],
                                          names=["lang", "size", "phrase", "f"])

    counted = docs.mapInArrow(run, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter((F.col("size") == 0) | (F.col("f") >= least))


def frequent(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = 3, least: int = 10) -> DataFrame:
    """Every phrase of 1 to ``most`` words that occurs ``least`` times in its
    language: lang, size, phrase, f; and, with size 0, each language's words.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks
    and tabs. A null text is empty, a null language is ``und``; repeated rows
    count each time; no rows give no rows.
    """
    spark = docs.sparkSession
    df = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))  # several a task, so that tasks are even
    filters = survivors(summaries(df, parts, most), parts, least).collect()  # bounded by FILTER_BITS
    return exact(df, Filter(filters, parts), most, least)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = 3, least: int = 10,
                 scale: int = 1_000_000, share_of: int = 50) -> DataFrame:
    """Phrases of 2 to ``most`` words with a = f(phrase) >= ``least``: lang,
    phrase, a, l, r, n, score. Of all cuts of a phrase the one with the lowest
    score ``scale`` * a * a // (l * r) counts (ties: the shortest first part);
    l and r are the parts' own counts, n the language's words. A phrase goes if
    a longer one around it has at least ``share_of`` % of its count.

    Counts are exact up to 15 digits; products are decimals of 38. A word that
    begins or ends many phrases is a hot join key: its partition is split by
    the adaptive skew join. See ``frequent`` for null, empty and repeated rows.
    """
    counts = cut_lineage(frequent(docs, text_col, lang_col, most, least))
    words = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    known = counts.filter("size > 0").select("lang", "phrase", "f")
    wide = counts.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def run_of(first, n):
        return F.array_join(F.slice("w", first, n), " ")

    cuts = wide.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", run_of(F.lit(1), F.col("k")).alias("_first"), run_of(F.col("k") + 1, F.size("w") - F.col("k")).alias("_rest"))
    left = known.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_first"), F.col("f").alias("l"))
    right = known.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, (cuts.lang == left._ll) & (cuts._first == left._first)).drop("_first", "_ll")
    cuts = cuts.join(right, (cuts.lang == right._rl) & (cuts._rest == right._rest)).drop("_rest", "_rl")
    score = F.expr(f"(CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * CAST({scale} AS DECIMAL(7,0))) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    best = best.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))

    inner = wide.filter("size > 2").select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n"))
    inner = inner.select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    inner = inner.select("lang", run_of(F.col("i"), F.col("n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").filter(F.col("_longer").isNull() | (100 * F.col("_longer") < share_of * F.col("a")))
    return kept.join(words, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top(found: DataFrame, limit: int) -> DataFrame:
    """Each language's first ``limit`` rows with their ``rank``: by score and a
    descending, then by the phrase's bytes. Ranks are limited before the
    shuffle, so a language's task reads ``limit`` rows of each partition."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
