"""Nearest neighbours, whitening and spelling variants against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.llm import nearest, registry, spelling, whiten
from llm.helpers import DATA, empty_documents, lower, odd_documents

SMALL = f"{DATA}/sf0.001"


# ---- nearest neighbours ----------------------------------------------------------------------


def brute_nearest(rows, k, asks=lambda name: name % 20 == 0):
    out = {}
    asked = {}
    for name, v in rows:
        if asks(name):
            asked[name] = min(v, asked.get(name, v))
    for q, v in asked.items():
        scored = sorted((-float((np.array(w) * np.array(v)).sum()), name) for name, w in rows if name != q and len(w) == len(v))
        out[q] = [(name, -s) for s, name in scored[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({name for name, _ in want[q]} & {name for _, name, _ in got.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("chunk", [1 << 19, 64 * 70])
def test_neighbours_of_the_given_table(spark, monkeypatch, chunk):
    monkeypatch.setattr(nearest, "CHUNK_ENTRIES", chunk)
    monkeypatch.setattr(nearest, "BLOCK_ENTRIES", 64 * 9)  # several blocks of queries
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got, want = found(registry.op11_nearest(spark, SMALL)), brute_nearest(rows, 20)
    assert recall(got, want) >= 0.95
    vectors = dict(rows)
    for q, hits in got.items():
        assert [rank for rank, _, _ in hits] == list(range(1, 21))
        assert sorted(hits, key=lambda h: (-h[2], h[1])) == hits
        assert all(score == pytest.approx(np.dot(vectors[q], vectors[name]), abs=1e-14) for _, name, score in hits)


def test_recall_on_other_shapes():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32)) * 3
    shapes = {
        "clusters": centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * 0.2,
        "lengths": rng.normal(size=(4000, 32)) * rng.lognormal(0, 1.5, size=(4000, 1)),
        "few dimensions": rng.normal(size=(4000, 2)),
        "one giant": np.concatenate([rng.normal(size=(3999, 16)), np.full((1, 16), 1e6)]),
    }
    for name, x in shapes.items():
        chunk, hits = nearest.Chunk(np.arange(len(x)), x), 0
        for q in range(0, 4000, 80):
            ids, scores = chunk.search(q, x[q], 20, -np.inf)
            top = ids[np.lexsort((ids, -scores))[:20]]
            true = x @ x[q]
            true[q] = -np.inf
            hits += len(set(top.tolist()) & set(np.argsort(-true)[:20].tolist()))
        assert hits / (50 * 20) >= 0.93, name


def test_a_third_of_all_vectors_alike(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [1.0] * 8 if k % 3 == 0 else rng.normal(size=8).tolist()) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, want = found(nearest.nearest(df, F.col("vec_id") % 20 == 0)), brute_nearest(rows, 20)
    assert recall(got, want) >= 0.95
    # equal scores: smaller ids first, none left out
    assert [name for _, name, _ in got[60]] == [name for name, _ in want[60]]


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=9).tolist()) for k in range(60)] + [(20, [9.0] * 9)]
    rows += [(k, [1e200, -1e200]) for k in (100, 101)] + [(200, [3.0, 4.0, 5.0])]
    bad = [(300, None), (301, []), (302, [1.0] * 8 + [None]), (320, [float("nan")] * 9), (303, [float("inf")] * 9), (340, [0.0] * 9), (None, [0.1] * 9)]
    df = spark.createDataFrame([(*r, "mine", 1.0, "x") for r in rows + bad], "vec_id bigint, embedding array<double>, v string, score double, dim string")
    got, want = found(nearest.nearest(df, F.col("vec_id") % 20 == 0)), brute_nearest([r for r in rows if r[0] < 100], 20)
    assert set(got) == {0, 20, 40, 100}
    assert recall({q: got[q] for q in want}, want) >= 0.95
    assert [name for _, name, _ in got[100]] == [101]
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ---- whitening -------------------------------------------------------------------------------


def brute_whitening(vectors, most=16):
    """(n, whitened, shares, deviations) from a dense covariance."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = lambda m: (n * m - sums).astype(float) / n
    v = centred(fit).T @ centred(fit) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return n, centred(x) @ u / np.sqrt(e), e / np.trace(v), [int(((n * r - sums) ** 2).sum()) for r in x]


def test_whitening_of_the_given_table(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    n, want, shares, deviations = brute_whitening([v for _, v in rows])
    got = {(r.vec_id, r.component): r for r in registry.op12_whitening(spark, SMALL).collect()}
    assert len(got) == 16 * len(rows)
    for k in range(16):
        mine = np.array([got[name, k + 1].whitened for name, _ in rows])
        assert np.abs(mine * np.sign(mine @ want[:, k]) - want[:, k]).max() < 1e-8
        assert got[rows[0][0], k + 1].explained == pytest.approx(shares[k], rel=1e-10)
    assert [got[name, 1].deviation for name, _ in rows] == deviations
    assert {r.n for r in got.values()} == {n}
    errors = {r.identity_error for r in got.values()}
    assert len(errors) == 1 and errors.pop() < 1e-10


def test_solver_on_hard_matrices():
    rng = np.random.default_rng(1)
    turn = lambda d: np.linalg.qr(rng.normal(size=(d, d)))[0]
    spectra = [[3] * 10 + [2] * 10 + [1] * 20, [3 + 1e-7 * k for k in range(10)] + [2 + 1e-10 * k for k in range(10)], np.logspace(0, -12, 30), [1] * 20, [5.0]]
    cases = [np.linalg.qr(turn(len(s)) @ np.diag(s) @ turn(len(s)), mode="r") for s in spectra]
    cases += [np.diag([1.0, 1, 1, 2, 2, 0, 0]), np.triu(rng.normal(size=(12, 12)))[:, ::-1].copy(), np.eye(7) * 1e-150]
    for r in cases:
        e, directions, shares = whiten.components(r, 10)
        s = np.linalg.svd(r, compute_uv=False)
        k = len(e)
        assert k == min(16, int((s > len(s) * whiten.EPS * s[0]).sum()))
        assert np.allclose(np.sqrt(e * 10), s[:k], rtol=1e-12, atol=1e-14 * s[0])
        assert np.abs(directions @ directions.T - np.eye(k)).max() < 1e-10
        scaled = r / s[0]
        assert np.abs(scaled.T @ (scaled @ directions.T) - directions.T * (s[:k] / s[0]) ** 2).max() < 1e-13
        assert shares.sum() <= 1 + 1e-12


def test_small_values_are_accurate():
    a, b = np.logspace(0, -40, 9), np.logspace(-1, -41, 9)[:8]
    dense = np.diag(a) + np.diag(b, 1)
    values = whiten.singular_values(a, b)
    # the product of all values is that of the diagonal, to full relative accuracy
    assert np.sum(np.log(values)) == pytest.approx(np.sum(np.log(a)), abs=1e-12)
    assert values[0] == pytest.approx(np.linalg.norm(dense, 2), rel=1e-13)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=5) * [3, 2, 1, 1, 0]).tolist()) for k in range(50)]
    rows += [(1, rows[0][1]), (None, rows[3][1])] + [(100 + k, rows[2][1]) for k in range(30)]  # repeated ids and vectors
    pairs = [(200, [1.0, 2.0]), (201, [2.0, 1.0]), (202, [5.0, -3.0])]
    bad = [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 5), (304, [float("inf")] * 5), (305, [1e300] * 3)]
    df = spark.createDataFrame([(*r, "mine", 1.0, "x") for r in rows + pairs + bad], "vec_id bigint, embedding array<double>, x string, n double, dim string")
    got = whiten.whiten(df).collect()
    mine = [r for r in got if r.vec_id is None or r.vec_id < 200]
    n, want, _, deviations = brute_whitening([v for _, v in rows], 4)
    assert len(mine) == 4 * len(rows) and {r.n for r in mine} == {n}  # the fifth entry never varies
    assert Counter(r.deviation for r in mine if r.component == 1) == Counter(deviations)
    assert sorted(abs(r.whitened) for r in mine) == pytest.approx(sorted(np.abs(want).ravel()), abs=1e-9)
    assert max(r.identity_error for r in got) < 1e-9
    assert {r.vec_id for r in got if r.vec_id and 200 <= r.vec_id < 300} == {200, 201, 202}
    assert not [r for r in got if r.vec_id == 305]  # alone in its length: nothing varies
    assert whiten.whiten(df.limit(0)).count() == 0


# ---- spelling --------------------------------------------------------------------------------


def brute_counts(docs, drop):
    out = Counter()
    for name, text in docs:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if name is None else name}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 6:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 5}


def brute_variants(counts):
    alphabet = sorted({c for w in counts for c in w})
    out = {}
    for w, n in counts.items():
        cuts = [(w[:k], w[k:]) for k in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet} | {a + c + b[1:] for a, b in cuts if b for c in alphabet}
        near = sorted((-counts[x], x) for x in edits - {w} if x in counts)
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    roots = {}
    for w in out:
        roots[w] = w
        while out[roots[w]][0]:
            roots[w] = out[roots[w]][0]
    return {(w, form, roots[w], n, n_near, form_n) for w, (form, n, n_near, form_n) in out.items()}


def rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("bucket", [1 << 15, 200])
def test_variants_of_the_given_texts(spark, monkeypatch, bucket):
    monkeypatch.setattr(spelling, "BUCKET_WORDS", bucket)
    monkeypatch.setattr(spelling, "TOGETHER", 333)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()]
    want = brute_variants(brute_counts(docs, 199))
    assert len(want) > 1000 and any(r[1] for r in want)
    assert rows(registry.op13_spelling_variants(spark, f"{DATA}/sf0.01")) == want


def test_a_third_of_all_words_with_one_half(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BUCKET_WORDS", 64)
    rng = np.random.default_rng(7)
    counts = {("prefix" if k % 3 == 0 else "") + "".join(rng.choice(list("abc"), 6)): int(rng.integers(1, 4000)) for k in range(900)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert rows(spelling.variants(df)) == brute_variants(counts)


def test_chains_lead_to_the_last_form(spark):
    counts = {"a" * (6 + k): 5 ** (k + 1) for k in range(12)} | {"b" * 6: 5, "ü" * 7: 7, "ü" * 6 + "ÿ": 35, "ü" * 6 + "é": 35}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = rows(spelling.variants(df))
    assert got == brute_variants(counts)
    assert {r[2] for r in got if r[0][0] == "a"} == {"a" * 17}
    assert {r[1] for r in got if r[0] == "ü" * 7} == {"ü" * 6 + "é"}  # equal counts: the smaller word


def test_words_of_odd_texts(spark):
    docs = [(r.doc_id, r.text) for r in odd_documents(spark).select("doc_id", "text").collect()]
    docs += [(50, "Straße×÷ ÀÉÿabc ABCDEFĀghijkl " * 6), (51, "z" * 200 + " "), (None, ("z" * 200 + " ") * 5)]
    more = spark.createDataFrame([(*r, "mine", "x") for r in docs], "doc_id bigint, text string, word string, n string")
    for drop in (None, 3):
        got = {r.word: r.n for r in spelling.word_counts(more, drop).collect()}
        assert got == brute_counts(docs, drop)
    assert spelling.word_counts(empty_documents(spark), 199).count() == 0
    assert spelling.variants(spelling.word_counts(empty_documents(spark), 199)).count() == 0
