"""Near-duplicates, packing, neighbours, ring, decontamination, URLs, WARC and
the pipeline: against brute force on small tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobledger.llm import components, decontaminate, neighbours, packing, ring, simhash, urls, warc
from jobledger.llm.catalog import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def groups_of(prints, most):
    """Union-find over all pairs."""
    up = list(range(len(prints)))

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= most:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def test_fingerprint_follows_the_definition():
    import xxhash

    def plain(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
        grams = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for t in ("", " \n", "One", "one two", "A b C", "the cat sat on the mat the cat sat", "é\u00a0x y z Ü ü"):
        assert simhash.fingerprint(bytes(V_LOWER[np.frombuffer(t.encode(), np.uint8)])) == plain(t)


V_LOWER = simhash.V.LOWER


@pytest.mark.parametrize("blocks", [4, 2, 1])
def test_links_match_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(simhash, "LEAF", 16)
    monkeypatch.setattr(simhash, "CHUNK", 24)
    rng = random.Random(blocks)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for x in list(prints)[:60] + [0] * 80:  # near copies, and one large group
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    found = simhash.links(df, 3, blocks)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in found.collect())
    roots = {r.node: r.root for r in components.components(found).collect()}
    got = [roots.get(v, v) for v in signed]
    want = groups_of(prints, 3)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("blocks", [2, 1])
def test_near_fingerprints_visit_each_others_shards(blocks):
    rng = np.random.default_rng(blocks)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for mask in simhash.masks(blocks):
        tree = simhash.plant(x, mask, 3 // blocks, 6)
        row, leaf, own = tree.shards(x)
        assert np.array_equal(np.sort(row[own]), np.arange(len(x)))  # one shard of its own
        there = set(zip(row.tolist(), leaf.tolist()))
        home = dict(zip(row[own].tolist(), leaf[own].tolist()))
        near = simhash.distance((x & np.uint64(mask))[:200, None], (x & np.uint64(mask))[None, :]) <= tree.radius
        assert all((int(a), home[int(b)]) in there for a, b in np.argwhere(near))


def test_near_duplicates_edge_rows(frame):
    rows = [(5, "a b c d"), (3, "A b  c D"), (9, ""), (7, None), (None, " "), (4, "something else here now"), (4, "something else here now"), (None, "null id text words")]
    docs = frame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, fp int")
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == Counter([(5, 3), (3, 3), (9, 7), (7, 7), (None, 7), (4, 4), (4, 4), (None, None)])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted(simhash.near_duplicates(docs).collect())
    want = groups_of([int(r.fingerprint, 16) for r in got], 3)
    low = {}
    for r, g in zip(got, want):
        low[g] = min(low.get(g, r.doc_id), r.doc_id)
    assert [r.component_id for r in got] == [low[g] for g in want]


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (3, 3), (7, 6), (11, 12), (12, 13), (13, 14), (14, 15), (None, 4), (2, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {2: 1, 3: 1, 7: 6, **{k: 10 for k in range(11, 16)}}
    assert components.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("open_bins", [1, 3, 1000])
def test_best_fit(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.randint(1, 64) for _ in range(400)]
    bins, offsets = packing.best_fit(lengths, 64, open_bins)
    opened, made = [], 0  # (free, time put there, bin); of equally full bins the last one used
    for i, (n, b, o) in enumerate(zip(lengths, bins.tolist(), offsets.tolist())):
        fits = [x for x in opened if x[0] >= n]
        if fits:
            x = min(fits, key=lambda x: (x[0], -x[1]))
            opened.remove(x)
        else:
            x, made = (64, 0, made), made + 1
        assert (b, o) == (x[2], 64 - x[0])
        if x[0] > n:
            opened.append((x[0] - n, i, x[2]))
        if len(opened) > open_bins:
            opened.remove(min(opened, key=lambda x: (x[0], -x[1])))


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    at, where = {}, {}
    for r in rows:
        at.setdefault(r.doc_id, []).append(r)
        where.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(at) == set(texts)
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own, start = sorted(at[i], key=lambda r: r.piece), 0
        assert len(own) == -(-len(ids) // capacity)
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, start) and (r.length == capacity or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[start: start + r.length], "<u4").tobytes())
            start += r.length
        assert start == len(ids)
    for parts in where.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= capacity


def test_packing_matches_the_tokenizer(frame):
    texts = {0: None, 1: "", 2: "a  b \n c\tq <|endoftext|> d'll 's  ", 3: "word " * 700, 4: "é日本語 12½", 5: " ", None: "no id"}
    docs = frame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, length int")
    check_packing(packing.pack_documents(docs, tokenizer_path(), capacity=128, shard_pieces=4).collect(), texts, 128)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_packing_uses_few_sequences(spark):
    from jobledger.llm.catalog import QUERIES

    got = QUERIES["op4_best_fit"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    check_packing(got, {r.doc_id: r.text for r in docs}, 2048)
    assert len({r.sequence_id for r in got}) <= 1.01 * sum(r.length for r in got) / 2048 + 1


def test_neighbours_against_brute_force(spark):
    from jobledger.llm.catalog import QUERIES

    for sf in ("sf0.01", "sf0.1"):
        got = QUERIES["op5_cross_polytope"](spark, f"/root/testdata/{sf}").toPandas()
        t = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
        ids, x = t.vec_id.to_numpy(), np.stack(t.embedding).astype(float)
        hits = 0
        for q, own in got.groupby("query_id"):
            s = x @ x[ids == q][0]
            s[ids == q] = -np.inf
            hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(own.vec_id))
            own = own.sort_values("rank")
            assert own["rank"].tolist() == list(range(1, 21)) and own.score.to_numpy() == pytest.approx(s[np.searchsorted(ids, own.vec_id)])
            assert (np.diff(own.score) <= 0).all()
        assert hits / len(got) >= 0.9 and got.query_id.nunique() == (ids % 20 == 0).sum()


def test_neighbours_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [3.0, 4.0]), (1, [3.0, 4.0]), (2, [6.0, 8.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, None), (7, [1.0, None]), (8, []),
            (9, [1.0, 0.0, 0.0]), (20, [1.0, 1.0, 1.0]), (40, [3.0, 4.0]), (None, [1.0, 1.0]), (1, [3.0, 4.0]), (-20, [-1.0, -1.0])]
    df = spark.createDataFrame([(i, v, 0, 0.5) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = {}
    for r in sorted(neighbours.search(df, k=3, share=1.0).collect()):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got == {0: [(1, 2, 50.0), (2, 1, 25.0), (3, 40, 25.0)], 20: [(1, 9, 1.0)], 40: [(1, 2, 50.0), (2, 0, 25.0), (3, 1, 25.0)],
                   -20: [(1, 0, -7.0), (2, 1, -7.0), (3, 40, -7.0)]}
    many = spark.range(300).selectExpr("id as vec_id", "array(1.0D, 2.0D) as embedding")
    got = neighbours.search(many, k=5, chunk=4).groupBy("query_id").agg(F.sort_array(F.collect_list("vec_id")).alias("v")).collect()
    assert {r.query_id: r.v for r in got} == {q: [v for v in range(6) if v != q][:5] for q in range(0, 300, 20)}
    assert neighbours.search(df.limit(0)).count() == 0


def nearest(ids, x, q, k=20):
    s = x @ x[ids == q][0]
    s[ids == q] = -np.inf
    return ids[np.lexsort((ids, -s))[:k]]


@pytest.mark.parametrize("norms", ["one", "outlier", "lognormal"])
def test_neighbours_recall_with_unequal_lengths(spark, norms):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[7] *= 100
    if norms == "lognormal":
        x *= rng.lognormal(0, 1, (5000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in neighbours.search(df, every=20, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ids = np.arange(len(x))
    found = [len(got.get(q, set()) & set(nearest(ids, x, q).tolist())) / 20 for q in range(0, 5000, 20)]
    assert np.mean(found) >= 0.95


def test_neighbours_are_k_and_ties_go_to_small_ids(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(15, 64))
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(x)]
    # of another dimension, one vector and its opposite's surroundings: a probe of the first misses these
    axis, many = np.eye(8)[0], rng.normal(size=(60, 8)) * 1e-3 - np.eye(8)[0]
    rows += [(100, axis.tolist())] + [(101 + i, v.tolist()) for i, v in enumerate(many)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(r.query_id for r in neighbours.search(df, every=20, k=20).collect())
    assert got == {0: 14, 100: 20, 120: 20, 140: 20, 160: 20}


def test_neighbours_ties_at_the_cut(spark):
    ids = list(range(1, 41))
    random.Random(3).shuffle(ids)
    # equal scores with the query, other coordinates apart
    rows = [(0, [1.0, 0.0, 0.0])] + [(i, [0.5, float(i), -float(i)]) for i in ids]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(df, every=1000, k=5, share=1.0).orderBy("rank").collect()  # all axes: nothing is missed
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.5) for i in range(1, 6)]


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = neighbours.rotate(x, 3)
    assert np.linalg.norm(y, axis=1) == pytest.approx(np.linalg.norm(x, axis=1))
    assert y @ y.T == pytest.approx(x @ x.T)


def dealt(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return {k: len(v) for k, v in slots.items()}


def test_ring_balance_and_movement(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    rows = ring.assign(docs).collect()
    n = dealt(rows)
    assert len(n) == 16 and max(n.values()) - min(n.values()) <= 1 and sum(n.values()) == 20_000
    for slack, most in ((0.0, 0.5), (0.25, 0.15)):
        was = {r.doc_id: r.shard for r in ring.assign(docs, slack=slack).collect()}
        now = {r.doc_id: r.shard for r in ring.assign(docs, shards=17, slack=slack).collect()}
        assert max(Counter(now.values()).values()) <= 20_000 * (1 + slack) / 17 + 1
        assert sum(was[i] != now[i] for i in was) / len(was) < most


def test_ring_edge_rows(frame):
    rows = [(1, "é"), (1, "é"), (None, None), (None, ""), (2, None)] + [(3, "same")] * 500
    docs = frame([(i, t, 9, "s") for i, t in rows], "doc_id long, text string, size int, shard string")
    got = ring.assign(docs, shards=7).collect()
    n = dealt(got)
    assert len(got) == 505 and max(n.values()) - min(n.values()) <= 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert ring.assign(docs.limit(0)).count() == 0


WORDS = [f"w{i}" for i in range(400)]


def test_decontamination_finds_substituted_overlaps(frame):
    rng = random.Random(4)
    items = {i: [rng.choice(WORDS) for _ in range(n)] for i, n in enumerate((13, 30, 8, 60, 6, 3))}
    docs, want = {}, set()
    for k in range(60):
        body = [rng.choice(WORDS) for _ in range(rng.randint(0, 200))]
        i = rng.choice(list(items))
        part = list(items[i])
        if k % 3 == 1 and len(part) > 12:  # up to two words replaced in any 13
            for j in range(5, len(part), 7):
                part[j] = "other"
        if k % 3 < 2:
            at = rng.randint(0, len(body))
            body[at:at] = part
            if len(items[i]) >= decontaminate.LEAST_ITEM and (k % 3 == 0 or len(part) > 12):
                want.add((k, i))
        docs[k] = ("  ".join(body) + ("!" if k % 2 else "")).upper()
    df = frame([(k, t, 1, None) for k, t in docs.items()] + [(None, None, 1, None), (100, "", 1, None)], "doc_id long, text string, item_id int, words string")
    bench = frame([(i, ", ".join(w)) for i, w in items.items()] + [(8, None), (9, "")], "item_id long, text string")
    got = decontaminate.overlaps(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= want
    flat = {k: re.findall(r"[a-z0-9]+", t.lower()) for k, t in docs.items()}
    for r in got:
        a, b = flat[r.doc_id][r.doc_word: r.doc_word + r.words], items[r.item_id][r.item_word: r.item_word + r.words]
        assert sum(x == y for x, y in zip(a, b)) == r.agreeing and r.agreeing >= 0.8 * r.words and r.words >= min(13, len(items[r.item_id]))
    left = decontaminate.decontaminate(df, bench)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(set(docs) - {r.doc_id for r in got} | {None, 100})
    assert decontaminate.overlaps(df, bench.limit(0)).count() == 0 and decontaminate.overlaps(df.limit(0), bench).count() == 0


def test_masks_find_all_pairs_of_substitutions():
    from itertools import combinations

    for bad in combinations(range(decontaminate.WORDS), 2):
        assert any(not any(m[b - s] == "1" for b in bad if 0 <= b - s < len(m)) for m in decontaminate.MASKS for s in range(decontaminate.WORDS - len(m) + 1))


def test_masks_find_all_substitutions_in_short_items():
    from itertools import combinations

    for n in range(1, 13):
        differ = max(d for d in range(n) if n - d >= 0.8 * n) if n >= decontaminate.LEAST_ITEM else 0
        assert differ == (0 if n < 6 else 1 if n < 10 else 2)
        for bad in combinations(range(n), differ):
            assert any(len(m) == n and all(m[b] == "0" for b in bad) for m in decontaminate.masks_of(n))


def test_decontamination_finds_short_items(frame):
    from itertools import combinations

    items = {n: WORDS[20 * n: 20 * n + n] for n in range(13)}
    docs, want = [], set()
    for n, words in items.items():
        for differ in range(4):
            for bad in combinations(range(n), differ):
                if n:
                    docs.append((len(docs), " ".join(["ahead"] * (len(docs) % 3) + ["other" if k in bad else w for k, w in enumerate(words)] + ["after"])))
                    if n - differ >= 0.8 * n and (n >= 6 or not differ):
                        want.add((docs[-1][0], n))
    df = frame(docs, "doc_id long, text string")
    bench = frame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_decontamination_in_slices_is_the_same(frame, monkeypatch):
    bench = frame([(i, " ".join(WORDS[i * 20: i * 20 + 20])) for i in range(8)], "item_id long, text string")
    docs = frame([(i, " ".join(WORDS[i * 20 - 5: i * 20 + 30])) for i in range(1, 8)], "doc_id long, text string")
    whole = sorted(decontaminate.overlaps(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", 30)
    assert len(decontaminate.slices(bench, "item_id", "text")) > 1
    assert sorted(decontaminate.overlaps(docs, bench).collect()) == whole and len(whole) >= 7


def test_url_rules(spark):
    rules = spark.createDataFrame([("net/", "block"), ("example.net/en/", "allow"), ("a.net/en/", "block"), ("org/fr/", "block"), ("x.y", "block"), (None, "block")], "rule string, verdict string")
    rows = [("http://EXAMPLE.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"), ("https://b.a.net/en/?q", "b.a.net", "/en/", "a.net/en/", "block"),
            ("x://net", "net", "", None, "allow"), ("http://net/", "net", "/", "net/", "block"), ("http://anet/", "anet", "/", None, "allow"),
            ("http://w.org/fr/a#b", "w.org", "/fr/a", "org/fr/", "block"), ("http://w.org/de/fr/", "w.org", "/de/fr/", None, "allow"),
            (None, "", "", None, "allow"), ("no scheme.net/", "", "", None, "allow"), ("://É.NET/a?b#c", "É.net", "/a", "net/", "block"),
            ("http://q.x.y?z", "q.x.y", "", "x.y", "block"), ("http://..net//", "..net", "//", "net/", "block"), ("a://b://c", "b:", "//c", None, "allow")]
    pages = spark.createDataFrame([(i % 11 or None, r[0], "h", "v") for i, r in enumerate(rows)] * 2, "page_id long, url string, host string, verdict string")
    for blocks in (1 << 16, 1):  # a filter that passes everything gives the same
        got = urls.judge(pages, rules, blocks=blocks).collect()
        assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter([(i % 11 or None, *r[1:]) for i, r in enumerate(rows)] * 2)
    assert {r.verdict for r in urls.judge(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert urls.judge(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.choices(range(50), k=rng.randint(0, 30))) for _ in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark, tmp_path):
    tricky = "x\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n"
    rows = [(1, "http://www.A.org/x", tricky), (2, None, tricky), (3, "http://a.org/x", None), (4, "u\r\nX: y", ""), (None, "z", "q"), (None, "z", "q"),
            (5, "é", "q"), (6, "http://b.a.org/", "é" * 9000), (6, "http://b.a.org/", "é" * 9000), (7, "http://a.org/w", "one")]
    pages = spark.createDataFrame([(i, u, t, 1) for i, u, t in rows], "page_id long, url string, html string, payload_bytes int").withColumn("date", F.timestamp_seconds(F.lit(9)))
    got = warc.capture_index(pages).collect()
    last = {}
    for i, _, t in rows:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)

    def want(i, t):
        raw = (t or "").encode()
        to = None if last[t or ""] == i else last[t or ""]
        return i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to

    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(want(i, t) for i, _, t in rows)
    order = [(r.url_key, r.date, r.id is not None, r.id or 0) for r in sorted(got, key=lambda r: (r.range, r.place))]
    assert order == sorted(order)
    assert all(r.record_type == "response" for r in warc.capture_index(pages, least_bytes=10**6).collect())
    path = str(tmp_path / "w")
    warc.write(pages, path, archive_bytes=5000)
    assert warc.read(spark, path).select("archive").distinct().count() > 1 and warc.read(spark, path).count() == len(rows)
    assert warc.capture_index(pages.limit(0)).count() == 0


def test_index_order_holds_for_cleaned_urls_and_fractions_of_seconds(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        urls = ["http://h/a\r\nz", "http://h/ab", "http://h/a\nb", "http://h/B", "http://é.h/", None, ""]
        rows = [(100 - i, urls[i % 7], f"p{i}", 9.9 - i % 10 / 10) for i in range(60)]
        pages = spark.createDataFrame(rows, "page_id long, url string, html string, at double").coalesce(1).withColumn("date", F.timestamp_seconds("at"))
        got = sorted(warc.capture_index(pages).collect(), key=lambda r: (r.range, r.place))
        order = [(r.url_key, r.date, r.id) for r in got]
        assert order == sorted(order) and len(got) == 60
        assert order.index(next(o for o in order if o[0] == "h)/ab")) < order.index(next(o for o in order if o[0] == "h)/az"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_run_out_of_order_is_an_error(spark):
    rows = [(i, u, "2024-01-01T00:00:00Z", 0, "", "response", None, "arc", i) for i, u in enumerate(["http://b/", "http://a/"])]
    runs = spark.createDataFrame(rows, "id long, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with pytest.raises(Exception, match="no sorted run"):
            warc.merge(runs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pipeline_keeps_texts_that_fit_several_languages(spark):
    import corpus_pipeline as cp

    schema = cp.table(spark, SMALL, "documents").schema
    learned = cp.table(spark, SMALL, "documents").limit(150)
    clean = [(10_000 + i, t, "en", "s", len(t)) for i, t in enumerate(["Hotel", "A", "Taxi Radio Hotel", "No", "E"])]
    noise = bytes(random.Random(1).choices(range(33, 127), k=4000)).decode()
    odd = [(20_000, noise, None, "s", 4000), (20_001, "ж" * 300, None, "s", 300), (20_002, "123 ...", None, "s", 7), (20_003, None, None, "s", 0)]
    kept = {r.doc_id for r in cp.keep_languages(spark, learned.union(spark.createDataFrame(clean + odd, schema)), SMALL).collect()}
    assert {c[0] for c in clean} <= kept and not kept & {20_001, 20_002, 20_003}


def test_pipeline_decisions(spark):
    import corpus_pipeline as cp

    docs = cp.table(spark, "/root/testdata/sf0.01", "documents")
    kept, before = docs, docs.count()
    for name, stage in cp.STAGES[:-1]:
        new = stage(spark, kept, "/root/testdata/sf0.01")
        assert new.columns == docs.columns, name
        kept = new.checkpoint()
    rows = kept.collect()
    assert 0.7 * before < len(rows) < before and not set(rows) - set(docs.collect())
    prints = [simhash.fingerprint(bytes(V_LOWER[np.frombuffer(r.text.encode(), np.uint8)])) for r in rows]
    assert len(set(groups_of(prints, 3))) == len(rows)
    bench = cp.table(spark, "/root/testdata/sf0.01", "benchmark")
    assert decontaminate.overlaps(kept, bench).count() == 0
    packed = cp.STAGES[-1][1](spark, kept, "").collect()
    check_packing(packed, {r.doc_id: r.text for r in rows}, 2048)


def test_pipeline_stages_take_nulls_and_empty_tables(spark):
    import corpus_pipeline as cp

    schema = cp.table(spark, SMALL, "documents").schema
    odd = [(None, "the and of that", "en", None, None), (None, "the and of it again with more words", None, "s", 1), (3, None, None, None, 0), (4, "", "en", "s", 0), (4, "word " * 3000, "en", "s", 1),
           (4, "word " * 3000, "en", "s", 1)]
    docs = spark.createDataFrame(odd, schema)
    for k, (_, stage) in enumerate(cp.STAGES):
        assert stage(spark, docs, SMALL).count() <= len(odd) + 2 * (k == 4)
        assert stage(spark, docs.limit(0), SMALL).collect() == []
    more = docs.withColumns({c: F.lit(1) for c in ("score", "predicted", "doc", "row", "id", "h", "none", "fp", "component_id", "lang_pred", "item_id", "_text")})
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, more, SMALL).columns == more.columns
    left = cp.drop_near_duplicates(spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in left) == Counter([None, None, 3, 4])
    assert cp.run(spark, SMALL).count() > 0
