"""Packing by the length histogram, with non-negative least squares.

Documents are tokenized once into a table of pieces; whole windows stand for
themselves. Of the other lengths only the histogram (at most one count for
each length) reaches the driver. There all combinations of up to three lengths
that fill a window are listed, the repeat counts that best rebuild the
histogram are solved for under x >= 0, and rounded up as far as pieces are
left. A piece is told its place by its rank among the pieces of its length.
The residual, a few per cent, is packed greedily in shards: the longest piece
that fits; if none fits, the longest left is cut, so that the window is full.
What a shard has left over becomes sequences of a power of two.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.packing import Encoder
from jobledger.llm.store import share, shared_path
from jobledger.plans.strategy import literal_frame

ROUNDS = 200  # of the solver
SHARD_IDS = 1 << 20  # aim for a task of the residual
BATCH_IDS = 1 << 21  # ids in a batch on their way to the table
RANK_BITS = 48


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of whole texts: id, doc_tokens, start, length, ids_crc32, ids
    (32-bit; null for a whole window, which is never cut again), part (the task
    that wrote it) and local (its rank in that part among equal lengths)."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = ["id", "doc_tokens", "start", "length", "ids_crc32", "ids", "part", "local"]
    tail = array("I", [end_id]).tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part, seen = Encoder(tokenizer_path), TaskContext.get().partitionId(), [0] * (capacity + 1)

        def send(batch, at, cols):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

        for batch in batches:
            at, cols, held = [], ([], [], [], [], [], [], []), 0
            for i, text in enumerate(batch.column(1)):
                ids = enc.encode(text.as_py()) + tail
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    own = ids[4 * start: 4 * (start + capacity)]
                    size = len(own) // 4
                    for c, v in zip(cols, (n, start, size, zlib.crc32(own), own if size < capacity else None, part, seen[size])):
                        c.append(v)
                    seen[size] += 1
                    at.append(i)
                held += n
                if held >= BATCH_IDS:
                    yield send(batch, at, cols)
                    at, cols, held = [], ([], [], [], [], [], [], []), 0
            yield send(batch, at, cols)

    return df.mapInArrow(run, f"id {dict(df.dtypes)['id']}, doc_tokens long, start long, length long, ids_crc32 long, ids binary, part int, local long")


def combinations(counts: np.ndarray, capacity: int) -> np.ndarray:
    """All combinations of two or three lengths that occur and fill a window,
    ascending, one a row (0: no third). ``counts``: by length."""
    there = np.asarray(counts) > 0
    there[0] = False
    have = np.flatnonzero(there[:capacity])
    x = have[(2 * have <= capacity) & there[capacity - have]]
    out = [np.stack([np.zeros_like(x), x, capacity - x], 1)]
    for a in have[3 * have <= capacity]:
        y = have[(have >= a) & (2 * have <= capacity - a)]
        y = y[there[capacity - a - y]]
        out.append(np.stack([np.full_like(y, a), y, capacity - a - y], 1))
    return np.concatenate(out)


def solve(combos: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that makes the combinations' lengths, each x times, come near
    ``counts``: weighted least squares by projected gradients with momentum,
    a length weighing by one over the combinations that use it."""
    n, target = len(counts), np.asarray(counts, float)
    flat = combos.ravel()
    uses = np.bincount(flat, minlength=n)
    uses[0] = 0
    weight = np.where(uses > 0, 1 / np.maximum(uses, 1), 0.0)
    step = 1 / np.maximum((combos > 0).sum(axis=1), 1)
    x = ahead = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds if len(combos) else 0):
        miss = (target - np.bincount(flat, weights=np.repeat(ahead, combos.shape[1]), minlength=n)) * weight
        new = np.maximum(0.0, ahead + step * miss[combos].sum(axis=1))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, x, t = new + (t - 1) / after * (new - x), new, after
    return x


class Plan:
    """Where each rank of each length goes. ``keys`` (length and first rank,
    ascending), ``base`` (first sequence) and ``place`` (offset) hold a run of
    ranks a row: at most three for each combination. ``slots``: ranks that have
    a place, by length; ``sequences``: how many there are."""

    def __init__(self, counts: np.ndarray, capacity: int, rounds: int = ROUNDS):
        counts = np.asarray(counts, np.int64)
        left, taken = counts.tolist(), [0] * (capacity + 1)
        runs, self.sequences = [], 0
        if left[capacity]:
            runs.append((capacity, 0, 0, 0))
            self.sequences = taken[capacity] = left[capacity]
        combos = combinations(counts, capacity)
        x = solve(combos, counts, rounds)
        order = np.argsort(-x, kind="stable")
        wanted = np.ceil(x[order]).astype(np.int64).tolist()
        for lengths, want in zip(combos[order].tolist(), wanted):
            lengths = [v for v in lengths if v]
            n = min(want, *(left[v] // lengths.count(v) for v in lengths))
            if n <= 0:
                continue
            offset = 0
            for v in lengths:
                runs.append((v, taken[v], self.sequences, offset))
                left[v] -= n
                taken[v] += n
                offset += v
            self.sequences += n
        rows = np.array(runs, np.int64).reshape(-1, 4)
        keys = (rows[:, 0] << RANK_BITS) + rows[:, 1]
        order = np.argsort(keys)
        self.keys, self.base, self.place = keys[order], rows[order, 2], rows[order, 3]
        self.slots = np.array(taken, np.int64)

    def places(self, length: np.ndarray, rank: np.ndarray):
        """Sequence and offset of ranks below their length's ``slots``."""
        key = (length << RANK_BITS) + rank
        run = np.searchsorted(self.keys, key, side="right") - 1
        return self.base[run] + key - self.keys[run], self.place[run]


def greedy(lengths, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces, longest first and cut where needed, so that every sequence
    is full and the last few have a power of two: (piece, from, to, sequence,
    offset). Equal lengths go in the order given."""
    by_size: list[list] = [[] for _ in range(capacity + 1)]
    there = 0
    for i in range(len(lengths) - 1, -1, -1):
        by_size[lengths[i]].append((i, 0))
        there |= 1 << lengths[i]
    out, now, fill, made = [], [], 0, 0
    while there:
        free = capacity - fill
        fits = there & ((2 << free) - 1)
        size = (fits or there).bit_length() - 1
        i, a = by_size[size].pop()
        if not by_size[size]:
            there ^= 1 << size
        n = min(size, free)
        if size > n:
            by_size[size - n].append((i, a + n))
            there |= 1 << (size - n)
        now.append((i, a, a + n))
        fill += n
        if fill == capacity:
            out += placed(now, [capacity], made)
            now, fill, made = [], 0, made + 1
    powers = [1 << k for k in range(fill.bit_length() - 1, -1, -1) if fill >> k & 1]
    return out + placed(now, powers, made)


def placed(pieces: list, sizes: list[int], first: int) -> list[tuple[int, int, int, int, int]]:
    """``pieces`` one after the other in sequences of ``sizes``, which add up
    to theirs, cut at the borders."""
    out, k, at = [], 0, 0
    for i, a, b in pieces:
        while a < b:
            n = min(b - a, sizes[k] - at)
            out.append((i, a, a + n, first + k, at))
            a, at = a + n, at + n
            if at == sizes[k]:
                k, at = k + 1, 0
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
                   end_id: int = 1, rounds: int = ROUNDS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenize and pack ``docs``: ``id_col``, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, one row a piece.

    Every sequence is full or has a power of two of ids, so none is padded. An
    empty or null text is the end id alone; null ids and repeated rows are
    packed like any other; no rows give no rows; other columns are not read.
    Texts longer than a window are cut into windows and a rest. The solver
    keeps some capacity ** 2 / 12 combinations, whatever the number of rows.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "pieces")
    tokenized(docs, tokenizer_path, id_col, text_col, capacity, end_id).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)

    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    plan = Plan(counts, capacity, rounds)
    slots = literal_frame(spark, [(int(v), int(plan.slots[v])) for v in np.flatnonzero(counts)], "length long, slots long")
    # parts in a random order for each length, so that no part has all of the residual
    order = Window.partitionBy("length").orderBy(F.xxhash64("part", "length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_part.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).join(F.broadcast(slots), "length")
    rank = F.col("before") + F.col("local")
    known = share(spark, plan)
    keep = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = dict(pieces.dtypes)["id"]
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            sequence, offset = known().places(batch.column(2).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    planned = pieces.drop("ids").join(ranks.filter("before < slots"), ["part", "length"]).filter(rank < F.col("slots"))
    planned = planned.select(*keep, rank.alias("rank")).mapInArrow(place, schema)

    lengths = np.arange(capacity + 1)
    shards = max(1, -(-int(((counts - plan.slots) * lengths).sum()) // shard_ids))
    sequences = plan.sequences

    def pack(key, table):
        import pyarrow as pa

        table = table.sort_by([("length", "descending"), ("_h", "ascending"), ("part", "ascending"), ("local", "ascending")])
        rows = greedy(table.column("length").to_pylist(), capacity)
        which, a, b, sequence, offset = (np.array(c, np.int64) for c in zip(*rows))
        ids = table.column("ids").combine_chunks()
        crc = [zlib.crc32(ids[i].as_buffer()[4 * f: 4 * t]) for i, f, t in zip(which.tolist(), a.tolist(), b.tolist())]
        own = table.select(["id", "start", "doc_tokens"]).take(pa.array(which))
        start = pa.array(own.column("start").to_numpy() + a)
        return pa.Table.from_arrays([own.column("id"), start, pa.array(b - a), pa.array(crc, pa.int64()), own.column("doc_tokens"),
                                     pa.array(sequences + sequence * shards + key[0].as_py()), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    rest = pieces.join(ranks.filter("before + n > slots"), ["part", "length"]).filter(rank >= F.col("slots"))
    mark = F.xxhash64("part", "length", "local")
    rest = rest.select(*keep, "ids", "part", "local", mark.alias("_h"), F.pmod(mark, F.lit(shards)).alias("_shard"))
    rest = rest.groupBy("_shard").applyInArrow(pack, schema)
    return planned.unionByName(rest).withColumnRenamed("id", id_col)
