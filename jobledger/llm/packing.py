"""Best-fit packing of tokenized documents into fixed-length sequences.

Documents are tokenized where they lie; only lengths travel on. Pieces are
dealt evenly to packing tasks by a hash, and each task runs bounded-space
online best fit: a fixed number of open bins, kept in lists by free space
under a bitset of the free spaces in use. A piece goes to the open bin that it
fills best, else to a new bin; if too many are open, the fullest is closed.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_BINS = 1 << 16
SHARD_PIECES = 100_000  # aim for a packing task

# fixed value: the byte-level pattern
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


class Encoder:
    """Token ids as 32-bit bytes, by the vocabulary of a ``tokenizers`` file.

    A byte-level file with the usual pattern is run by tiktoken, which gives
    the same ids several times as fast; any other by ``tokenizers`` itself.
    An added token's string in a text is that token, as ``tokenizers`` has it.
    """

    def __init__(self, path: str):
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        plain = plain and not any(a != b and a.startswith(b) for a in special for b in special)
        if usual and plain and model["type"] == "BPE" and not spec.get("normalizer"):
            import tiktoken

            byte = {c: b for b, c in enumerate(byte_letters())}
            ranks = {bytes(byte[c] for c in k): v for k, v in model["vocab"].items() if k not in special}
            encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.ids = lambda text: encoding.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        return array("I", self.ids(text)).tobytes()


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it is visible Latin-1, else the next free one from U+0100."""
    seen = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    rest = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + rest.index(b)) for b in range(256)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Tokenize every whole text (null: empty) and append ``end_id``. Per
    piece: ``id_col``, piece, start, length, ids_crc32. Only a document longer
    than ``capacity`` is cut; its first piece takes what is left over by whole
    pieces. No ids are kept, so rows stay small."""
    df = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kind = dict(df.dtypes)[id_col]
    tail = array("I", [end_id]).tobytes()

    def run(batches):
        import pyarrow as pa

        enc = Encoder(tokenizer_path)
        for batch in batches:
            at, cols = [], ([], [], [], [])
            for i, text in enumerate(batch.column(1)):
                ids = enc.encode(text.as_py()) + tail
                n, start, k = len(ids) // 4, 0, 0
                size = n if n <= capacity else n % capacity or capacity
                while start < n:
                    for c, v in zip(cols, (k, start, size, zlib.crc32(ids[4 * start: 4 * (start + size)]))):
                        c.append(v)
                    at.append(i)
                    start, k, size = start + size, k + 1, capacity
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    return df.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths, capacity: int, open_bins: int = OPEN_BINS) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the order given. Lengths are from 1
    to ``capacity``. At most ``open_bins`` bins are open at any time."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, held, made = 0, 0, 0  # used: bit f is set if a bin with free space f is open
    for i, n in enumerate(lengths):
        fits = used >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            own = by_free[free]
            b = own.pop()
            if not own:
                used ^= 1 << free
            held -= 1
        else:
            b, free = made, capacity
            made += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - n
        if left:
            by_free[left].append(b)
            used |= 1 << left
            held += 1
            if held > open_bins:
                low = (used & -used).bit_length() - 1
                by_free[low].pop()
                held -= 1
                if not by_free[low]:
                    used ^= 1 << low
    return bins, offsets


def pack(pieces_: DataFrame, shards: int, id_col: str = "doc_id", capacity: int = 2048, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to ``pieces_``. A shard's pieces arrive
    longest first, equal ones in the order of a hash, so a repeated attempt
    packs them alike; rows that agree in all columns are interchangeable."""
    order = F.xxhash64(F.col(id_col).cast("string"), "piece", "ids_crc32")
    df = pieces_.withColumn("_order", order).withColumn("_shard", F.pmod(F.xxhash64("_order"), F.lit(shards)))
    fields = ", ".join(f"`{c}` {t}" for c, t in pieces_.dtypes)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_order", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = best_fit(pdf["length"].to_numpy().tolist(), capacity, open_bins)
        return pdf.drop(columns=["_order", "_shard"]).assign(sequence_id=bins + (int(key[0]) << 40), offset=offsets)

    return df.groupBy("_shard").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048, open_bins: int = OPEN_BINS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Tokenize and pack ``docs``: the columns of ``pieces`` with sequence_id
    and offset. Empty and null texts are a piece of the end id alone; no rows
    give no rows. Null ids are packed like any other."""
    from jobledger.plans.strategy import cut_lineage

    cut = cut_lineage(pieces(docs, tokenizer_path, id_col, text_col, capacity))
    shards = max(1, -(-cut.count() // shard_pieces))
    return pack(cut, shards, id_col, capacity, open_bins)
