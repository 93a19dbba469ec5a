"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates vectors by three rounds of random signs and a fast Hadamard
transform and assigns each to the nearest signed axis. A query probes the axes
nearest to it in every table (multiprobe), and all vectors assigned to them
are candidates, ranked by their exact inner product in double precision. So
that the largest inner product, not only the smallest angle, is found, vectors
are first lifted to one length by a further coordinate: each to that of the
longest vector of its band of norms (``BANDS`` to an octave), so that a lift is
short whatever other norms there are. Bands share the rotations, so a query
probes the same axes in all of them, and their candidates are ranked together.

Axes are dealt to ``GROUPS`` groups a table; a group's vectors and the queries
that probe it meet in chunks of bounded size, however many fall to one axis.
There each axis's vectors are multiplied with the queries that probe this axis,
and with no others; a query's bests of all axes are then ranked.
Equal vectors are searched as one; it keeps the k + 1 smallest ids, since ties
go to the smaller id. Only per-query bests leave a task. A query that found
fewer than k others, while there are more, is searched again among all vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.plans.strategy import cut_lineage

TABLES = 6
PROBES = 0.25  # share of the signed axes that a query probes in each table
BANDS = 8  # bands of norms to an octave
WHOLE = -1  # in place of a table: all candidates are ranked
GROUPS = 8
CHUNK = 8192  # vectors, and queries, that meet in a task


def hadamard(y: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of each row (a power of 2 long)."""
    n, d = y.shape
    h = 1
    while h < d:
        z = y.reshape(n, -1, 2, h)
        y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return y / np.sqrt(d)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-random rotation of unit vectors, padded with zeros."""
    d = 1 << max(1, int(np.ceil(np.log2(x.shape[1]))))
    y = np.zeros((len(x), d))
    y[:, : x.shape[1]] = x
    for signs in np.random.default_rng([11, table, d]).choice([-1.0, 1.0], (3, d)):
        y = hadamard(y * signs)
    return y


def axes(x: np.ndarray, table: int) -> np.ndarray:
    """The signed axis nearest to each vector: 2 * axis, + 1 if negative."""
    y = rotate(x, table)
    best = np.abs(y).argmax(1)
    return 2 * best + (y[np.arange(len(y)), best] < 0)


def probed(x: np.ndarray, table: int, share: float) -> np.ndarray:
    """Which signed axes each query probes: the nearest ``share`` of them."""
    y = rotate(x, table)
    near = np.stack([y, -y], 2).reshape(len(y), -1)
    m = max(1, int(np.ceil(share * near.shape[1])))
    rank = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1, kind="stable")
    return rank < m


def lifted(x: np.ndarray, most) -> np.ndarray:
    """Vectors of length up to ``most`` (one for all, or one for each) as unit
    vectors with one more coordinate; among equal ``most``, inner products with
    unlifted queries keep their order."""
    x = x / np.reshape(most, (-1, 1))
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]], 1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([x, np.zeros((len(x), 1))], 1)


def matrix(column) -> np.ndarray:
    return np.stack(list(column)).astype(float)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, x: rows whose vector has no null or non-finite component and is
    not zero."""
    x = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), x.alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("x", lambda v: v != 0)
    return rows.filter(F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull())


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
           tables: int = TABLES, share: float = PROBES, chunk: int = CHUNK) -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank (from
    1), vec_id, score of the ``k`` nearest found among all other rows.

    Vectors of different lengths of dimension never meet. Repeated rows count
    once as candidates of an id. Null ids take no part.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col)
    is_query = F.pmod(F.col("id"), F.lit(every)) == 0

    def key(pdf):
        import hashlib

        return [hashlib.blake2b((np.asarray(v) + 0.0).tobytes(), digest_size=16).digest() for v in pdf["x"]]

    def unite(batches):
        for pdf in batches:
            pdf = pdf.assign(key=key(pdf)).sort_values("id")
            g = pdf.groupby("key", sort=False)
            out = g.agg(x=("x", "first"), query=("id", lambda i: bool((i % every == 0).any()))).reset_index()
            yield out.assign(ids=[sorted(set(i))[: k + 1] for i in g["id"].agg(list)])[["key", "x", "query", "ids"]]

    def name(batches):
        for pdf in batches:
            yield pdf.assign(key=key(pdf))[["id", "key"]]

    local = rows.mapInPandas(unite, "key binary, x array<double>, query boolean, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)  # a short list from each batch
    base = local.groupBy("key").agg(F.first("x").alias("x"), F.max("query").alias("query"), ids.alias("ids")).withColumn("dim", F.size("x"))
    most = F.array_max(F.transform("x", F.abs))  # squares of the quotients neither overflow nor vanish
    base = base.withColumn("most", most).withColumn("length", F.col("most") * F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + (v / F.col("most")) * (v / F.col("most"))))).drop("most")
    # lengths about 1 lie in the middle of a band
    base = cut_lineage(base.withColumn("band", F.floor(F.log2("length") * BANDS + 0.5)))
    # a row for each band of each dimension
    bands = {(r.dim, r.band): r.m for r in base.groupBy("dim", "band").agg(F.max("length").alias("m")).collect()}
    salt = lambda n: F.pmod(F.xxhash64("key"), n)

    low = F.col("ids")[0].alias("low")

    def deal(batches):
        """Each vector's group in each table; each query's groups."""
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                x, q = matrix(part["x"]), part["query"].to_numpy(bool)
                up = lifted(x, np.array([bands[dim, b] for b in part["band"]]))
                for t in range(tables):
                    axis = axes(up, t)
                    yield part[["key", "x", "dim", "low"]].assign(t=t, g=axis % GROUPS, axis=axis, query=False)
                    if q.any():
                        hits = probed(unit(x[q]), t, share)
                        for g in range(GROUPS):
                            some = hits[:, g::GROUPS].any(1)
                            yield part[["key", "x", "dim", "low"]][q][some].assign(t=t, g=g, axis=-1, query=True)

    def rank(at: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, out = int(at[1]), []
        q, c = pdf[pdf["query"]], pdf[~pdf["query"]]
        if not len(q) or not len(c):
            return pd.DataFrame({"q": [], "c": [], "score": []})
        c = c.iloc[np.argsort(c["axis"].to_numpy(), kind="stable")]
        axis, y, names, low = c["axis"].to_numpy(), matrix(c["x"]), c["key"].to_numpy(), c["low"].to_numpy()
        ends = [*np.flatnonzero(np.diff(axis)) + 1, len(axis)]
        slack = 1e-12 * np.linalg.norm(y, axis=1).max()
        for a in range(0, len(q), 256):
            some = q.iloc[a: a + 256]
            x = matrix(some["x"])
            hits = None if t == WHOLE else probed(unit(x), t, share)
            pairs = []
            for i, j in zip([0, *ends[:-1]], ends):
                asks = np.arange(len(x)) if hits is None else np.flatnonzero(hits[:, axis[i]])
                if len(asks):
                    score, m = x[asks] @ y[i:j].T, min(k + 1, j - i)
                    cut = -np.partition(-score, m - 1, axis=1)[:, m - 1] - slack * np.linalg.norm(x[asks], axis=1)
                    r, b = np.nonzero(score >= cut[:, None])
                    pairs.append((asks[r], b + i))
            if not pairs:
                continue
            r, b = (np.concatenate(z) for z in zip(*pairs))
            # the same for a pair wherever it meets
            s = np.concatenate([(y[b[i: i + 65536]] * x[r[i: i + 65536]]).sum(1) for i in range(0, len(b), 65536)])
            order = np.lexsort((low[b], -s, r))
            r, b, s = r[order], b[order], s[order]
            kept = np.arange(len(r)) - np.searchsorted(r, r) <= k
            out.append(pd.DataFrame({"q": some["key"].to_numpy()[r[kept]], "c": names[b[kept]], "score": s[kept]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"q": [], "c": [], "score": []})

    def meet(dealt: DataFrame) -> DataFrame:
        """q, c, score: the bests of each chunk of queries in each chunk of vectors."""
        sizes = dealt.groupBy("dim", "t", "g").agg(F.sum((~F.col("query")).cast("long")).alias("n"), F.sum(F.col("query").cast("long")).alias("m"))
        sizes = sizes.select(F.col("dim").alias("_dim"), F.col("t").alias("_t"), F.col("g").alias("_g"), F.ceil(F.greatest("n", F.lit(1)) / chunk).alias("cn"), F.ceil(F.greatest("m", F.lit(1)) / chunk).alias("cm"))
        # a row for each group of axes: GROUPS * tables for each dimension
        met = dealt.join(F.broadcast(sizes), (F.col("dim") == F.col("_dim")) & (F.col("t") == F.col("_t")) & (F.col("g") == F.col("_g")))
        lists = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
        own_i, own_j = F.array(salt(F.col("cn"))), F.array(salt(F.col("cm")))
        met = met.withColumn("i", F.explode(F.when(F.col("query"), lists(F.col("cn"))).otherwise(own_i)))
        met = met.withColumn("j", F.explode(F.when(F.col("query"), own_j).otherwise(lists(F.col("cm")))))
        return met.select("dim", "t", "g", "i", "j", "key", "x", "low", "axis", "query").groupBy("dim", "t", "g", "i", "j").applyInPandas(rank, "q binary, c binary, score double")

    def best(found: DataFrame) -> DataFrame:
        """q, score, vec_id: the k + 1 best of each query."""
        found = found.groupBy("q", "c").agg(F.max("score").alias("score"))
        pairs = found.join(base.select(F.col("key").alias("c"), "ids"), "c").select("q", "score", "ids")
        order = [F.col("score").desc(), F.col("ids")[0]]
        pairs = pairs.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("r") <= k + 1)
        top = pairs.select("q", "score", F.explode("ids").alias("vec_id"))
        return top.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("r") <= k + 1).drop("r")

    dealt = base.select("key", "x", "dim", "query", "band", low).mapInPandas(deal, "key binary, x array<double>, dim int, low long, t int, g int, axis int, query boolean")
    top = cut_lineage(best(meet(dealt)))
    # a query finds itself among its k + 1, or all there are in its dimension
    there = base.groupBy("dim").agg(F.least(F.sum(F.size("ids")), F.lit(k + 1)).alias("want"))
    have = top.groupBy(F.col("q").alias("key")).agg(F.count("*").alias("have"))
    short = base.filter("query").join(there, "dim").join(have, "key", "left").filter(F.coalesce("have", F.lit(0)) < F.col("want"))
    short = cut_lineage(short.select("key", "x", "dim", low))
    if not short.isEmpty():
        sides = [short.withColumn("query", F.lit(True)), base.join(short.select("dim").distinct(), "dim", "left_semi").select("key", "x", "dim", low).withColumn("query", F.lit(False))]
        again = sides[0].unionByName(sides[1]).withColumns({"t": F.lit(WHOLE), "g": F.lit(0), "axis": F.lit(-1)})
        top = top.join(short.select(F.col("key").alias("q")), "q", "left_anti").unionByName(best(meet(again)))
    asked = rows.filter(is_query).mapInPandas(name, "id long, key binary").distinct()
    out = asked.join(top, asked.key == top.q).filter("vec_id <> id")
    r = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.col("score").desc(), "vec_id"))
    return out.withColumn("rank", r.cast("int")).filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
