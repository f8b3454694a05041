"""Top-k search, whitening and collocations against plain Python, and words that only look alike to a weak hash."""

import math
import random

import numpy as np
import pytest

import brute
from sheaftext.llm import collocations, decontaminate, fingerprints, hmm, jaccard_join, topk_search, whitening, words

VECTORS = "vec_id bigint, embedding array<double>, label int, score string, rank string"


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def vectors(seed, n=90, dims=6, spread=0.3):
    """Ties, repeated rows and ids, a hot vector, odd rows, and columns whose names clash."""
    draw = random.Random(seed)
    rows = [(i, [round(draw.gauss(0, spread), 2) for _ in range(dims)]) for i in range(n)]
    hot = rows[1][1]
    rows += [(200 + i, hot) for i in range(30)] + [(20, hot), (20, hot), (None, hot), (None, [0.0] * dims)]
    rows += [(300, None), (320, [None] * dims), (340, [math.nan] * dims), (360, [math.inf] + [0.0] * (dims - 1)), (380, []), (400, [0.5] * (dims - 2)), (420, [1.0] * (dims + 3))]
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], VECTORS).repartition(parts)


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD", 16)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    monkeypatch.setattr(topk_search, "SHARDS", 2)
    monkeypatch.setattr(topk_search, "AT_ONCE", 3)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("spread", [0.3, 1e4, 3e6])
def test_top_k(spark, small_shards, seed, spread):
    rows = vectors(seed, spread=spread)
    for k in (20, 3):
        got = [tuple(r) for r in topk_search.top_k(topk_search.build_index(frame(spark, rows)), k).collect()]
        same(got, brute.top_k(rows, k))


def test_top_k_of_few_and_no_rows(spark):
    for rows in ([], [(20, [0.1, 0.2])], [(20, [0.1]), (3, [0.4])], [(None, [1.0]), (3, [1.0])]):
        got = [tuple(r) for r in topk_search.top_k(topk_search.build_index(frame(spark, rows, 1))).collect()]
        same(got, brute.top_k(rows))


def test_impact_order():
    x = np.random.default_rng(3).integers(-30, 30, (50, 7))
    rows, starts, impact, rests = topk_search.impact_order(x)
    assert len(rows) == (x != 0).sum() and (np.diff(impact) <= 0).all() and (np.diff(rests, axis=0) <= 1e-3).all()
    left = x.astype(float)
    for s in range(len(starts) - 1):
        level, d, sign = s // 14, s % 14 // 2, s % 2
        own = rows[starts[s] : starts[s + 1]]
        assert ((x[own, d] < 0) == bool(sign)).all()
        left[own, d] -= -impact[level] if sign else impact[level]
    assert (np.sqrt((left**2).sum(axis=1)) <= rests[-1]).all()


def test_wide_scores_stop_at_the_ends_of_a_long(spark):
    rows = [(20, [1e300, 1e300]), (1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [1.0, 0.0])]
    got = {r.vec_id: r.score for r in topk_search.top_k(topk_search.build_index(frame(spark, rows))).collect()}
    assert got == {1: 2**63 - 1, 2: -(2**63), 3: 2**63 - 1}


@pytest.mark.parametrize("hot", [1, 1000])
@pytest.mark.parametrize("by_count", [False, True])
def test_whitening(spark, monkeypatch, hot, by_count):
    monkeypatch.setattr(whitening, "HOT", hot)
    monkeypatch.setattr(whitening, "CHUNK", 40)
    rows = [(i, v) for i, v in vectors(4) if v is None or len(v) == 6 or v == []]
    rows = [r for r in rows if r[1] != []]
    got = whitening.whiten(frame(spark, rows), components=4, by_count=by_count).collect()
    x = np.array([v for _, r in rows if (v := brute.integers(r, shift=1_000_000))], float)
    fit = x if by_count else np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    values, turn = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    values, turn = values[::-1], turn[:, ::-1]
    expected = {tuple(v): np.abs((np.array(v) - mean) @ turn[:, :4] / np.sqrt(values[:4])) for v in x.tolist()}
    assert len(got) == 4 * len(x)
    assert {r.n for r in got} == {len(fit)} and max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(abs(r.whitened))
    if not by_count:
        n, _, deviations = brute.whitening_parts(rows)
        assert n == len(fit)
        for i, v in rows:
            own = brute.integers(v, shift=1_000_000)
            if own:
                found = by_row[i, deviations[tuple(own)]]
                assert [found[c][0] for c in (1, 2, 3, 4)] == pytest.approx(list(expected[tuple(map(float, own))]), abs=1e-8)


def test_whitening_signs_are_one_choice(spark):
    rows = vectors(5)
    got = whitening.whiten(frame(spark, rows), components=2).collect()
    z = {}
    for r in got:
        z.setdefault(r.component, []).append(r.whitened)
    assert all(min(v) < 0 < max(v) for v in z.values())


def test_whitening_without_spread(spark):
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])], [(1, None)], [(1, [])]):
        assert whitening.whiten(frame(spark, rows, 1)).count() == 0
    line = [(i, [i / 64, 2 * i / 64, 0.0]) for i in range(5)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    far = whitening.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 0.0])])).collect()
    assert {r.deviation for r in far if r.vec_id != 3} == {None}


def test_whitening_fills_up_short_vectors(spark):
    short, full = [(1, [0.5]), (2, [0.25, 1.0])], [(1, [0.5, 0.0]), (2, [0.25, 1.0])]
    key = lambda r: (r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9))
    same(*([key(r) for r in whitening.whiten(frame(spark, rows)).collect()] for rows in (short, full)))


def phrases(seed, n=160):
    draw = random.Random(seed)
    names = [f"w{k}" for k in range(25)]
    fixed = [["new", "york", "city"], ["by", "and", "by"], ["a", "a", "a"], ["x", "y"], ["Über", "DER", "straße"]]
    texts = []
    for _ in range(n):
        w = []
        for _ in range(draw.randint(0, 25)):
            w += draw.choice(fixed) if draw.random() < 0.4 else [draw.choice(names)]
        texts.append("".join(x + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "!"]) for x in w))
    langs = ["en", None, "de", "und"]
    return [(langs[k % 4], t) for k, t in enumerate(texts)] + [("en", None), (None, ""), ("fr", " \t"), ("en", "new york " * 300)]


@pytest.mark.parametrize(("least", "first", "share"), [(5, 2000, 1 / 16), (3, 4, 1 / 64), (2, 1, 1 / 64), (100, 2000, 1 / 16)])
def test_collocations(spark, monkeypatch, least, first, share):
    monkeypatch.setattr(collocations, "SHARE", share)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 200)
    monkeypatch.setattr(collocations, "HELD", 40)
    monkeypatch.setattr(collocations, "NAMED", 10)
    docs = phrases(least)
    df = spark.createDataFrame([(k, t, lang, "r", 1) for k, (lang, t) in enumerate(docs)], "doc_id bigint, text string, lang string, rank string, n int").repartition(3)
    got = [tuple(r) for r in collocations.collocations(df, least, first=first).collect()]
    same(got, brute.collocations(docs, least, first=first))
    assert len(got) > 0


def test_collocations_of_no_rows(spark):
    for docs in ([], [(None, None)], [("en", "a b c")]):
        assert collocations.collocations(spark.createDataFrame(docs, "lang string, text string")).count() == 0


def alike():
    """Two words of 1,024 letters that a polynomial modulo 2^64 can't tell apart, whatever its base."""
    bits = [0]
    for _ in range(10):
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_look_alike(spark):
    a, b = alike()
    h = words.words(np.frombuffer(f"{a} {b}".encode(), np.uint8), np.array([0, 2049])).hashes
    assert len(a) == len(b) == 1024 and h[0] != h[1]
    docs = spark.createDataFrame([(1, f"{a} x y z"), (2, f"{b} x y z"), (3, a), (4, b)], "doc_id bigint, text string")
    joined = {r.doc_id: (r.component_id, r.n_shingles, r.n_links) for r in jaccard_join.jaccard_components(docs).collect()}
    assert joined == {i: (i, 1, 0) for i in (1, 2, 3, 4)}
    items = spark.createDataFrame([(7, a)], "item_id bigint, text string")
    found = decontaminate.find_items(decontaminate.build_index(docs), items).collect()
    assert sorted(r.doc_id for r in found if r["items"]) == [1, 3]
    near = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    assert near[3].near_next == 0 and near[3].fingerprint != near[4].fingerprint
    held = hmm.crc_mod_column("doc_id", 7) == 2
    got = {r.doc_id: r for r in hmm.language_scores(docs, held, rounds=1).collect()}
    expected = {e[0]: e for e in brute.base_scores([(i, t) for i, t in ((1, f"{a} x y z"), (2, f"{b} x y z"), (3, a), (4, b))])}
    for i, r in got.items():
        assert (r.n_tokens, r.n_known) == expected[i][1:3] and r.base_score == pytest.approx(expected[i][4])
