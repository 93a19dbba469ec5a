"""Histogram packing, collocations and whitening: against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from harness import SF_SMALL, compare, duck, type_differences

from jobledger.llm import catalog, collocations, histogram, packing, whitening
from jobledger.llm.catalog import tokenizer_path


def ids_of(texts, end):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], np.uint32) for i, t in texts.items()}


def check_sequences(rows, texts, capacity, end=1):
    """Each id in one piece, checksums right, sequences gapless and unpadded."""
    ids, by_doc, by_seq = ids_of(texts, end), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[i][r.start:at].tobytes())
        assert at == len(ids[i])
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    return len(by_seq)


# packing -----------------------------------------------------------------


def test_combinations_are_all_that_fill_the_window():
    counts = np.array([9, 1, 0, 2, 1, 3, 1, 0, 1, 5, 1])
    have = [v for v in range(1, 10) if counts[v]]
    want = {(0, a, b) for a in have for b in have if a <= b and a + b == 10}
    want |= {(a, b, c) for a in have for b in have for c in have if a <= b <= c and a + b + c == 10}
    assert set(map(tuple, histogram.combinations(counts, 10).tolist())) == want


def test_solver_rebuilds_a_histogram_that_combinations_made():
    rng = np.random.default_rng(1)
    combos = histogram.combinations(np.ones(65, int), 64)
    truth = np.where(rng.random(len(combos)) < 0.1, rng.integers(1, 50, len(combos)), 0)
    counts = np.bincount(combos.ravel(), weights=np.repeat(truth, 3), minlength=65)
    counts[0] = 0
    x = histogram.solve(combos, counts, 2000)
    back = np.bincount(combos.ravel(), weights=np.repeat(x, 3), minlength=65)
    assert (x >= 0).all() and np.abs(back - counts)[1:].max() < 0.01 * counts.max()


@pytest.mark.parametrize("seed", range(3))
def test_plan_gives_each_rank_its_own_place(seed):
    rng = np.random.default_rng(seed)
    counts = rng.poisson(rng.random(65) * 20)
    counts[0] = 0
    plan = histogram.Plan(counts, 64)
    length = np.repeat(np.arange(65), plan.slots)
    rank = np.concatenate([np.arange(n) for n in plan.slots])
    assert (plan.slots <= counts).all() and plan.slots.sum() > 0.8 * counts.sum()
    sequence, offset = plan.places(length, rank)
    spans = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist()):
        spans[s].append((o, o + n))
    assert set(spans) == set(range(plan.sequences))
    for own in spans.values():
        own.sort()
        assert own[0][0] == 0 and own[-1][1] == 64 and all(a[1] == b[0] for a, b in zip(own, own[1:]))


@pytest.mark.parametrize("lengths", [[], [1], [63] * 50, [1] * 200, list(range(1, 64)) * 3, [40, 40, 40, 1]])
def test_greedy_fills_every_sequence(lengths):
    fill, own = Counter(), defaultdict(list)
    for i, a, b, s, o in histogram.greedy(lengths, 64):
        assert o == fill[s]
        fill[s] += b - a
        own[i].append((a, b))
    for i, n in enumerate(lengths):
        cuts = sorted(own[i])
        assert cuts[0][0] == 0 and cuts[-1][1] == n and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))
    assert all(v == 64 or v & (v - 1) == 0 for v in fill.values())


@pytest.mark.parametrize("shard_ids", [1 << 20, 300])
def test_histogram_packing_matches_the_tokenizer(frame, shard_ids):
    rng = random.Random(5)
    words = ["the", "Zebra", "naïve", "x1", "\n\n", "<|endoftext|>", "我们", "a" * 40]
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 30, 200]))) for i in range(150)}
    texts |= {1000: None, 1001: "", 1002: "same text " * 30, 1003: "same text " * 30, 1004: "long " * 300_000}
    rows = frame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, length int")
    check_sequences(histogram.pack_documents(rows, tokenizer_path(), capacity=128, shard_ids=shard_ids).collect(), texts, 128)


def test_histogram_packing_edge_rows(frame):
    none = histogram.pack_documents(frame([], "doc_id long, text string"), tokenizer_path())
    assert none.collect() == []
    rows = frame([(None, "a b c")] * 40 + [(7, None)] * 100 + [(8, "x")] * 3, "doc_id long, text string")
    out = histogram.pack_documents(rows, tokenizer_path(), capacity=16).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == {None: 40, 7: 100, 8: 3}
    assert sum(r.length for r in out) == 40 * 4 + 100 + 3 * 2


def test_least_squares_registered(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    check_sequences(catalog.QUERIES["op11_least_squares"](spark, SF_SMALL).collect(), texts, 2048)


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> \n<|endoftext|>x", "<|endof", "a" * 3000 + " " * 3000])
def test_added_tokens_are_encoded_as_the_named_call_does(text):
    enc = packing.Encoder(tokenizer_path())
    assert np.frombuffer(enc.encode(text), np.uint32).tolist() == ids_of({0: text}, 0)[0][:-1].tolist()


# collocations ------------------------------------------------------------


def phrases(rows, most):
    """Counts by language and phrase, by the definition."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, " ".join(w[i: i + k])) for i in range(len(w) - k + 1))
    return f, n


def plain_collocations(rows, most, least, share_of=50):
    f, n = phrases(rows, most)
    wide = {k: a for k, a in f.items() if a >= least and " " in k[1]}
    out = {}
    for (lang, p), a in wide.items():
        w = p.split(" ")
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        longer = [b for (o, q), b in wide.items() if o == lang and len(q) > len(p) and f" {p} " in f" {q} "]
        if not any(100 * b >= share_of * a for b in longer):
            s, _, left, right = min(cuts)
            out[lang, p] = (a, left, right, n[lang], s)
    return out


def some_texts(seed, n=400):
    rng = random.Random(seed)
    words = ["new", "York", "city", "été", "a.", "b,", "of", "the", "x\ty", "\n", "Q;R", "\x1c", "\x0b"]
    texts = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 30))) for _ in range(n)]
    return [(rng.choice(["en", "EN", "fr", None]), t) for t in texts] + [("en", None), ("en", ""), (None, " . ")]


@pytest.mark.parametrize("most", [2, 3, 4])
def test_collocations_match_brute_force(frame, monkeypatch, most):
    monkeypatch.setattr(collocations, "FLUSH", 500)  # many summaries to merge
    rows = some_texts(most)
    got = collocations.collocations(frame([(*r, 1.5) for r in rows], "lang string, text string, score double"), most=most, least=10).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got} == plain_collocations(rows, most, 10)


def test_long_texts_are_mined_in_windows(frame, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 64)
    rows = some_texts(9, 60) + [("en", " ".join(t or "" for _, t in some_texts(11, 200))), ("en", "x" * 300 + " new york " * 40)]
    got = collocations.collocations(frame(rows, "lang string, text string"), least=5).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got} == plain_collocations(rows, 3, 5)


def test_collocations_of_a_text_above_a_megabyte(frame):
    text = " ".join(random.Random(3).choices(["red", "green", "blue", "deep sea", "end."], k=700_000))
    assert len(text) > 3 << 20
    got = collocations.collocations(frame([("en", text)], "lang string, text string"), least=10_000).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got} == plain_collocations([("en", text)], 3, 10_000)


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(2)
    for least in (2, 5, 10):
        keys = np.concatenate([rng.zipf(1.3, 20_000).astype(np.uint64), rng.integers(1 << 40, 1 << 41, 20_000).astype(np.uint64)])
        rng.shuffle(keys)
        got = collocations.Summary(len(keys) // least + 1)
        for part in np.array_split(keys, 13):
            got.merge(*(c.astype(t) for c, t in zip(np.unique(part, return_counts=True), (np.uint64, np.int64))))
        assert len(got.keys) <= got.capacity and got.lost < least
        real = dict(zip(*np.unique(keys, return_counts=True)))
        held = dict(zip(got.keys.tolist(), got.counts.tolist()))
        assert all(k in held for k, c in real.items() if c >= least)
        assert all(real[k] - got.lost <= c <= real[k] for k, c in held.items())


def test_a_full_filter_only_lets_more_through(frame, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    rows = some_texts(21)
    got = collocations.collocations(frame(rows, "lang string, text string"), least=10).collect()
    assert {(r.lang, r.phrase): r.score for r in got} == {k: v[-1] for k, v in plain_collocations(rows, 3, 10).items()}


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    a, b, c = 400_000_000_001, 700_000_000_003, 900_000_000_007
    score = spark.range(1).selectExpr(
        f"(CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0))) DIV (CAST({b} AS DECIMAL(15,0)) * CAST({c} AS DECIMAL(15,0))) AS s").first().s
    assert score == 1_000_000 * a * a // (b * c)


def test_collocations_edge_rows(frame):
    assert collocations.collocations(frame([], "lang string, text string")).collect() == []
    assert collocations.collocations(frame([(None, None), ("en", "")], "lang string, text string"), least=1).collect() == []
    ties = [("en", "b a. d c. f e.")] * 10
    top = collocations.top(collocations.collocations(frame(ties, "lang string, text string")), 2).orderBy("rank").collect()
    assert [(r.rank, r.phrase, r.score) for r in top] == [(1, "b a", 1_000_000), (2, "d c", 1_000_000)]


def test_collocations_registered(spark):
    sql = catalog.ORACLE["op12_collocations"]
    df, con = catalog.QUERIES["op12_collocations"](spark, SF_SMALL), duck(SF_SMALL)
    problems, n = compare(df, con, sql)
    assert not problems and n > 100 and not type_differences(df, con, sql)


# whitening ---------------------------------------------------------------


def plain_whitening(rows, most, weights):
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    fit, copies = np.unique(x, axis=0, return_counts=True)
    w = np.ones(len(fit), np.int64) if weights == "one" else copies
    n, s = int(w.sum()), (w[:, None] * fit).sum(0)
    c = fit - s / n
    v = (c * w[:, None]).T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], (x - s / n) @ q / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_matches_brute_force(frame, weights):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[i % 3].tolist()) for i in range(400)]  # hot vectors
    got = whitening.whiten(frame(rows, "vec_id long, embedding array<double>"), most=5, weights=weights).collect()
    n, far, z, explained = plain_whitening(rows, 5, weights)
    assert len(got) == 5 * len(rows)
    place = {i: k for k, (i, _) in enumerate(rows)}
    mine = np.zeros_like(z)
    for r in got:
        mine[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == far[place[r.vec_id]] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert np.allclose(mine * np.sign((mine * z).sum(0)), z, atol=1e-8)


def test_whitening_edge_rows(frame):
    schema = "vec_id long, embedding array<float>, n string"
    assert whitening.whiten(frame([], schema)).collect() == []
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, "a"), (2, [], "a"), (3, [1.0, None], "a"), (4, [nan, 1.0], "a"), (5, [1.0, -inf], "a")]
    assert whitening.whiten(frame(bad, schema)).collect() == []
    one = whitening.whiten(frame([*bad, (None, [1.0, 2.0], "a"), (None, [1.0, 2.0], "a")], schema)).collect()
    assert len(one) == 4 and {(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(None, 1, 0, None, None, None)}
    # a direction without spread, lengths fitted apart, entries beyond a long
    mixed = [(1, [0.0, 5.0], ""), (2, [1.0, 5.0], ""), (3, [1.0], ""), (4, [3.0], ""), (5, [3e38, 0.0, 0.0], ""), (6, [0.0, 1.0, 0.0], "")]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame(mixed, schema)).collect()}
    assert abs(got[1, 1].whitened) == pytest.approx(1) and got[1, 2].whitened is None and got[1, 2].explained == 0 and got[1, 1].identity_error < 1e-12
    assert got[3, 1].n == 2 and got[3, 1].deviation == 2 * 0 + 128**2 and got[5, 1].deviation is None


def test_deviations_wrap_only_on_the_way():
    x = np.array([[3_037_000_499, 0], [2_000_000_000, 0], [4_000_000_000, 0]], np.int64)
    own = whitening.Fit(1, [0, 0])
    got, over = own.deviations(x)
    assert got[:2].tolist() == [3_037_000_499**2, 4 * 10**18] and over.tolist() == [False, False, True]


def test_whitening_registered(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = catalog.QUERIES["op13_whitening"](spark, SF_SMALL).collect()
    n, far, z, explained = plain_whitening(rows, 16, "one")
    place = {i: k for k, (i, _) in enumerate(rows)}
    assert len(got) == 16 * len(rows)
    assert all(r.deviation == far[place[r.vec_id]] and r.n == n and r.identity_error <= 1e-4 for r in got)
    assert max(abs(abs(r.whitened) - abs(z[place[r.vec_id], r.component - 1])) for r in got) < 1e-6
