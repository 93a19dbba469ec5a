"""Whitening of embeddings by the covariance of their distinct vectors.

Entries are put on an integer grid, so equal vectors meet exactly. Each
distinct vector is kept once with its count; the fit weighs it by one or by
that count. Sums are exact integers; the centred covariance is one matrix
product a batch, added up by Spark. Each distinct vector is whitened once, and
the rows take their result by a join: vectors that hold more than a 1024th of
all rows, of which there are fewer than 1024, by a broadcast, the rest by a
shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.llm.store import share, shared_path
from jobledger.plans.strategy import literal_frame

HOT_PARTS = 1024  # a vector with more than this part of all rows is broadcast
LEAST = 1e-12  # of the trace: components below it have no direction
FARTHEST = float(1 << 52)  # grid steps; entries beyond are put there


def grid(vector: Column, steps: int, shift: int) -> Column:
    """floor(steps * entry) + shift of each entry, as longs."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.lit(float(steps)) * c.cast("double")))) + F.lit(shift).cast("long"))


def usable(vector: Column) -> Column:
    """True for a vector that is not null, with finite entries only."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def by_length(column):
    """(rows, matrix) of an Arrow list column for each length from 1 on."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[at[rows][:, None] + np.arange(d)]


class Fit:
    """Count, exact sums and components of the vectors of one length."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.mean = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) - self.rest / self.n

    def solve(self, cov: np.ndarray, most: int) -> None:
        """Unit eigenvectors of ``cov`` by falling eigenvalue, at most ``most``."""
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(-values, kind="stable")[:most]
        values, trace = np.maximum(values[order], 0.0), float(np.trace(cov))
        self.real = values > LEAST * trace
        self.turn = vectors[:, order] / np.sqrt(np.where(self.real, values, 1.0))
        self.explained = values / trace if trace > 0 else np.full(len(order), np.nan)

    def deviations(self, x: np.ndarray):
        """Sum of (n * x - S)^2 of each row, exact; masked beyond a long. Whole
        numbers wrap at 64 bits, which a sum that fits a long survives."""
        far = ((self.centred(x) * self.n) ** 2).sum(axis=1)
        with np.errstate(over="ignore"):
            t = (x - self.mean).astype(np.uint64) * np.uint64(self.n) - self.rest.astype(np.uint64)
            out = (t * t).sum(axis=1, dtype=np.uint64)
        over = far >= 2.0**63 * (1 + 1e-6)
        for i in np.flatnonzero(~over & (far > 2.0**63 * (1 - 1e-6))):
            over[i] = sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(x[i] - self.mean, self.rest)) >= 1 << 63
        return np.where(over, 0, out).astype(np.int64), over


def added_up(df: DataFrame, kind: str, cells) -> dict[int, list]:
    """Add up, over all tasks, the arrays of ``kind`` (long or double) that
    ``cells(batch)`` gives by length. Spark adds them; only the sums, one array
    a length, reach the driver."""

    def run(batches):
        import pyarrow as pa

        held: dict = {}
        for batch in batches:
            for d, values in cells(batch):
                held[d] = held[d] + values if d in held else values
        for d, values in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), d, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                             names=["d", "cell", "value"])

    sent = df.mapInArrow(run, f"d int, cell int, value {kind}")
    total = F.sum(F.col("value").cast("decimal(38,0)")) if kind == "long" else F.sum("value")
    out: dict[int, list] = {}
    for row in sent.groupBy("d", "cell").agg(total.alias("value")).orderBy("d", "cell").collect():
        out.setdefault(row.d, []).append(row.value)
    return out


def fit(vectors: DataFrame, most: int, weights: str) -> dict[int, Fit]:
    """A ``Fit`` for each length of the distinct ``vectors`` (x, copies)."""
    one = weights == "one"

    def weight(batch, rows):
        return np.ones(len(rows), np.int64) if one else batch.column(1).to_numpy()[rows]

    def sums(batch):
        for rows, x in by_length(batch.column(0)):
            w = weight(batch, rows)
            low, high = x & 0xFFFF, x >> 16  # so that a task's sums fit 64 bits
            yield x.shape[1], np.concatenate([[w.sum()], w @ low, w @ high])

    found = {}
    for d, cells in added_up(vectors, "long", sums).items():
        cells = [int(c) for c in cells]
        found[d] = Fit(cells[0], [low + (high << 16) for low, high in zip(cells[1: d + 1], cells[d + 1:])])
    known = share(vectors.sparkSession, found)

    def products(batch):
        for rows, x in by_length(batch.column(0)):
            c = known()[x.shape[1]].centred(x)
            yield x.shape[1], ((c * weight(batch, rows)[:, None]).T @ c)[np.triu_indices(x.shape[1])]

    for d, cells in added_up(vectors, "double", products).items():
        cov = np.zeros((d, d))
        cov[np.triu_indices(d)] = np.array(cells) / found[d].n
        found[d].solve(cov + np.triu(cov, 1).T, most)
    return found


def transform(vectors: DataFrame, model) -> DataFrame:
    """Whiten each distinct vector: x, copies, d, deviation, z (null entries
    for components without a direction)."""

    def run(batches):
        import pyarrow as pa

        fits = model()
        for batch in batches:
            for rows, x in by_length(batch.column(0)):
                own = fits[x.shape[1]]
                z = own.centred(x) @ own.turn
                far, over = own.deviations(x)
                k = z.shape[1]
                flat = pa.array(z.reshape(-1), mask=np.tile(~own.real, len(rows)))
                z = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(rows) + 1, k, dtype=np.int32)), flat)
                kept = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), pa.array(np.full(len(rows), x.shape[1], np.int32)),
                                                  pa.array(far, mask=over), z], names=["x", "copies", "d", "deviation", "z"])

    return vectors.mapInArrow(run, "x array<long>, copies long, d int, deviation long, z array<double>")


def identity_errors(white: DataFrame, found: dict[int, Fit], weights: str) -> dict[int, float | None]:
    """For each length, the largest entry of the whitened vectors' covariance
    minus the identity, measured on the vectors; None if no component has a
    direction."""
    one, real = weights == "one", {d: f.real for d, f in found.items()}

    def products(batch):
        sizes = batch.column(1).to_numpy()
        for d in np.unique(sizes):
            rows = np.flatnonzero(sizes == d)
            keep = real[int(d)]
            z = np.stack([batch.column(2)[int(i)].values.to_numpy(zero_copy_only=False) for i in rows])[:, keep]
            w = np.ones(len(rows)) if one else batch.column(0).to_numpy()[rows].astype(float)
            yield int(d), np.concatenate([w @ z, ((z * w[:, None]).T @ z).reshape(-1)])

    out: dict = {d: None for d in found}
    for d, cells in added_up(white.select("copies", "d", "z"), "double", products).items():
        k = int(real[d].sum())
        mean, second = np.array(cells[:k]) / found[d].n, np.array(cells[k:]).reshape(k, k) / found[d].n
        out[d] = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max()) if k else None
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16, steps: int = 64,
           shift: int = 1_000_000, weights: str = "one") -> DataFrame:
    """One row for each usable row and component: ``id_col``, component (from
    1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry go, as do
    empty vectors, which have no component. Vectors of different lengths are
    fitted apart. ``weights``: ``one`` counts each distinct grid vector once,
    ``count`` as often as it occurs. Repeated rows and null ids come out once
    a row. A component whose eigenvalue vanishes has null ``whitened`` and is
    left out of ``identity_error``, which is null if none remains; ``explained``
    is null if all vectors are one. ``deviation`` is null where it exceeds a
    long. No rows give no rows; other columns are not read.
    """
    spark = df.sparkSession
    vector = F.col(vector_col)
    rows = df.filter(usable(vector) & (F.size(vector) > 0)).select(F.col(id_col).alias("_id"), grid(vector, steps, shift).alias("x"))
    path = shared_path(spark, "vectors")
    rows.groupBy("x").agg(F.count("*").alias("copies")).write.parquet(path)
    vectors = spark.read.parquet(path)
    found = fit(vectors, most, weights)
    path = shared_path(spark, "whitened")
    transform(vectors, share(spark, found)).write.parquet(path)
    white = spark.read.parquet(path)
    errors = identity_errors(white, found, weights)

    all_rows = white.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > all_rows // HOT_PARTS
    given = [F.xxhash64("x").alias("_h"), "x", "d", "deviation", "z"]
    keyed = rows.withColumn("_h", F.xxhash64("x"))
    near = keyed.join(F.broadcast(white.filter(hot).select(*given)), ["_h", "x"], "left")
    far = near.filter("z IS NULL").select("_id", "_h", "x").join(white.filter(~hot).select(*given), ["_h", "x"])
    names = ["_id", "d", "deviation", "z"]
    out = near.filter("z IS NOT NULL").select(*names).unionByName(far.select(*names))

    def number(v):
        return None if v is None or v != v else float(v)

    facts = [(d, f.n, k + 1, number(e), errors[d]) for d, f in found.items() for k, e in enumerate(f.explained)]
    facts = literal_frame(spark, facts, "d int, n long, component int, explained double, identity_error double")
    out = out.select("_id", "d", "deviation", F.posexplode("z").alias("_k", "whitened")).withColumn("component", F.col("_k") + 1)
    out = out.join(F.broadcast(facts), ["d", "component"])  # `most` rows a length
    return out.select(F.col("_id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error")
