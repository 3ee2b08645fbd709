"""Token vectors against counts by hand and against NumPy's eigenvectors."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.operators import token_vectors as V
from sahaf.operators.pooling import mean_pool
from sahaf.session import staged

TEXTS = [
    "The cat sat on the mat. The cat, the cat!", "A dog sat on the cat.\nNo dog no", None, "", "word", "x x x x",
    "The dog and the cat sat. A mat and a dog ran on.", "Ran, ran the dog; sat 12 the mat? On and on.",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "n"), (1, TEXTS[1], "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, token string")


def sentences(text):
    found = re.findall(r"[^.!?\n]+(?:\.\d[^.!?\n]*)*[.!?]*", text or "")
    return [re.sub(r"[^a-z\s]", "", s.lower()).split() for s in found if s.strip()]


def brute_counts(texts, window):
    out = Counter()
    for w in (s for t in texts for s in sentences(t)):
        for i in range(len(w)):
            for j in range(i + 1, min(i + window + 1, len(w))):
                out[w[i], w[j]] += 1
                out[w[j], w[i]] += 1
    return out


@pytest.mark.parametrize("window", [1, 2, 5])
def test_counts_and_weights(spark, docs, window):
    texts = [r.text for r in docs.collect()]
    want = brute_counts(texts, window)
    counts = staged(V.cooccurrence(docs, window), "near")
    assert {(r.term, r.context): r.n for r in counts.collect()} == want
    total, sums = sum(want.values()), Counter()
    for (a, _), n in want.items():
        sums[a] += n
    weights = {k: math.log(n * total / (sums[k[0]] * sums[k[1]])) for k, n in want.items()}
    got = {(r.term, r.context): r.weight for r in V.ppmi(counts).collect()}
    assert set(got) == {k for k, w in weights.items() if w > 0}
    assert all(abs(got[k] - weights[k]) < 1e-9 for k in got)


def random_matrix(spark, rng, terms, rank):
    """Entries of a symmetric matrix with ``rank`` strong blocks and some noise, none below 0."""
    block = np.arange(terms) % rank
    m = np.where(block[:, None] == block[None, :], 1.0 + block[:, None], 0.0) + rng.random((terms, terms)) * 0.05
    m = (m + m.T) / 2
    rows = [(f"t{i}", f"t{j}", float(m[i, j])) for i in range(terms) for j in range(terms) if m[i, j]]
    return m, staged(spark.createDataFrame(rows, "term string, context string, weight double").repartition(4), "matrix")


def test_the_subspace_equals_numpy(spark):
    m, weights = random_matrix(spark, np.random.default_rng(0), 60, 5)
    got = {r.term: r.vec for r in V.fit_token_vectors(weights, 5).collect()}
    found = np.array([got[f"t{i}"] for i in range(60)])
    values, axes = np.linalg.eigh(m)
    first = np.argsort(-np.abs(values))[:5]
    want = axes[:, first] * np.sqrt(np.abs(values[first]))
    assert np.linalg.norm(found @ found.T - want @ want.T) < 1e-3 * np.linalg.norm(want @ want.T)


@pytest.mark.parametrize("hot", [0, 7, 60])
def test_products_take_one_row_a_term_whatever_is_hot(spark, monkeypatch, hot):
    m, weights = random_matrix(spark, np.random.default_rng(2), 60, 4)
    monkeypatch.setattr(V, "CELLS", 50)
    monkeypatch.setattr(V, "ROWS", 9)
    _, places, lists = V.neighbours(weights, hot)
    assert places.count() == hot and lists.count() == 60
    assert lists.selectExpr("max(size(near))").first()[0] == hot
    assert lists.where("is_hot AND size(far) > 0").count() == 0
    rng = np.random.default_rng(3)
    x, turn = rng.random((60, 6)), rng.random((6, 4))
    rows = spark.createDataFrame([(f"t{i}", x[i].tolist()) for i in range(60)], "term string, vec array<double>")
    got = {r.term: r.vec for r in V._times(lists, places, rows, turn).collect()}
    assert np.allclose([got[f"t{i}"] for i in range(60)], m @ x @ turn)
    found = {r.term: (r.vec, r.n) for r in V.fit_token_vectors(weights, 4, hot).collect()}
    vecs = np.array([found[f"t{i}"][0] for i in range(60)])
    values, axes = np.linalg.eigh(m)
    first = np.argsort(-np.abs(values))[:4]
    want = axes[:, first] * np.sqrt(np.abs(values[first]))
    assert np.linalg.norm(vecs @ vecs.T - want @ want.T) < 1e-3 * np.linalg.norm(want @ want.T)
    assert {n for _, n in found.values()} == {60}


def test_fewer_terms_than_columns(spark):
    m, weights = random_matrix(spark, np.random.default_rng(1), 6, 2)
    got = {r.term: r.vec for r in V.fit_token_vectors(weights, 8).collect()}
    found = np.array([got[f"t{i}"] for i in range(6)])
    values, axes = np.linalg.eigh(m)
    want = (axes * np.abs(values)) @ axes.T
    assert np.allclose(found @ found.T, want, atol=1e-6)


def test_every_token_has_its_vector(spark, docs):
    weights = staged(V.ppmi(staged(V.cooccurrence(docs), "near")), "ppmi")
    model = staged(V.fit_token_vectors(weights, 4), "model")
    vectors = {r.term: r.vec for r in model.collect()}
    got = V.token_vectors(docs, model).collect()
    want = Counter((r.doc_id, i, j, w) for r in docs.collect() for i, s in enumerate(sentences(r.text)) for j, w in enumerate(s))
    assert Counter((r.doc_id, r.sent, r.pos, r.token) for r in got) == want
    assert all((r.vec is None) == (r.token not in vectors) for r in got)
    assert all(np.allclose(r.vec, vectors[r.token], atol=1e-5) for r in got if r.vec)
    pooled = {r.doc_id: r.vec for r in mean_pool(V.token_vectors(docs, model).where("vec IS NOT NULL"), ["doc_id"]).collect()}
    own = [vectors[w] for s in sentences(TEXTS[6]) for w in s if w in vectors]
    assert np.allclose(pooled[6], np.mean(own, axis=0), atol=1e-5)


def test_frequent_terms_are_sent_to_the_tokens(spark, docs):
    model = spark.createDataFrame([("cat", [1.0], 3)], "term string, vec array<double>, n long")
    plan = V.token_vectors(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_signs_are_even_and_the_same_everywhere(spark):
    terms = spark.range(4000).select(F.col("id").cast("string").alias("t"))
    x = np.array([r[0] for r in terms.select(V.signs(F.col("t"), 80)).collect()])
    assert set(np.unique(x)) == {-1.0, 1.0} and np.abs(x.mean(axis=0)).max() < 0.08
    assert np.abs(x.T @ x / 4000 - np.eye(80)).max() < 0.1


def test_empty_corpus(spark, docs):
    none = docs.where("false")
    assert V.cooccurrence(none).count() == 0 and V.token_rows(none).count() == 0
    model = spark.createDataFrame([], "term string, vec array<double>, n long")
    assert V.token_vectors(docs.where("doc_id = 4"), model).collect()[0].vec is None


def test_pairs_are_weighed_once_whatever_is_combined_or_sent(spark, monkeypatch):
    texts = ["  a b 1 a c. b a ! \t", "c c\tc d. a", None, "", "12 . 3", "ı ÇA b d d a. zz a b"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    want = Counter()
    for sent in (s for t in texts for s in re.split(r"[.!?\n]", t or "")):
        w = re.sub(r"[^\w\s]|\d|_", "", sent).lower().split()
        for by in range(1, V.WINDOW + 1):
            for x, y in zip(w, w[by:]):
                want[x, y] += 1
                want[y, x] += 1
    total, sums = sum(want.values()), Counter()
    for (x, _), n in want.items():
        sums[x] += n
    weights = {k: math.log(n * total / (sums[k[0]] * sums[k[1]])) for k, n in want.items()}
    weights = {k: round(w, 6) for k, w in weights.items() if w > 0}
    for size, hot in ((1 << 20, 1 << 16), (3, 2)):
        monkeypatch.setattr(V, "PAIR_WORDS", size)
        monkeypatch.setattr(V.with_sums, "__defaults__", (hot,))
        pairs = V.pair_counts(docs).collect()
        assert all(r.a <= r.b for r in pairs) and len(pairs) == len({(r.a, r.b) for r in pairs})
        counts = V.cooccurrence(docs)
        assert {(r.term, r.context): r.n for r in counts.collect()} == want
        got = V.ppmi(counts, 6).collect()
        assert len(got) == len(weights) and {(r.term, r.context): r.weight for r in got} == pytest.approx(weights, abs=2e-6)


@pytest.mark.parametrize("hot", [1, 9, 40])
def test_rows_of_terms_that_are_not_hot_are_neither_moved_nor_written(spark, monkeypatch, hot):
    """A hub meets every term and few others meet: the same vectors as from whole matrices, and few rows written."""
    rng, terms, dim = np.random.default_rng(5), 40, 4
    m = np.zeros((terms, terms))
    m[0, 1:] = m[1:, 0] = rng.random(terms - 1) + 0.5
    for i, j in [(3, 4), (4, 4), (7, 30), (11, 12), (2, 30)]:
        m[i, j] = m[j, i] = rng.random() + 0.5
    rows = [(f"t{i}", f"t{j}", float(m[i, j])) for i in range(terms) for j in range(terms) if m[i, j]]
    weights = staged(spark.createDataFrame(rows, "term string, context string, weight double"), "matrix")
    monkeypatch.setattr(V, "ROWS", 3)
    monkeypatch.setattr(V, "CELLS", 7)
    kept, written = V.staged, []

    def counted(df, name, **options):
        out = kept(df, name, **options)
        if name not in ("given", "image") and "vec" in df.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(V, "staged", counted)
    got = {r.term: r for r in V.fit_token_vectors(weights, dim, hot).collect()}
    far = {"t3", "t4", "t7", "t30", "t11", "t12", "t2"}
    hottest = {r.term for r in V.neighbours(weights, hot)[1].collect()}
    assert written and max(written) <= len(far - hottest)
    assert {t: r.n for t, r in got.items()} == {f"t{i}": int((m[i] > 0).sum()) for i in range(terms)}
    names = spark.createDataFrame([(f"t{i}",) for i in range(terms)], "t string")
    columns = dim + V.OVERSAMPLE
    sign = {r.t: r.x for r in names.select("t", V.signs(F.col("t"), columns).alias("x")).collect()}
    x = m @ np.array([sign[f"t{i}"] for i in range(terms)])
    for _ in range(V.PASSES):
        x = m @ x @ V._orthonormal(x.T @ x)
    turn = V._orthonormal(x.T @ x)
    small = turn.T @ x.T @ m @ x @ turn
    values, axes = np.linalg.eigh((small + small.T) / 2)
    first = np.argsort(-np.abs(values))[:dim]
    want = x @ turn @ (axes[:, first] * np.sqrt(np.abs(values[first])))
    found = np.array([got[f"t{i}"].vec for i in range(terms)])
    assert np.allclose(found @ found.T, want @ want.T, atol=1e-7)


def test_pooling_moves_rows_of_rare_tokens_only(spark, monkeypatch):
    texts = ["common words here", "words common rare", "here common"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = spark.createDataFrame([("common", [1.0, 2.0], 9), ("words", [3.0, 0.0], 8), ("here", [0.0, 1.0], 7), ("rare", [5.0, 5.0], 1), ("x" * 300, [1.0, 1.0], 99)], "term string, vec array<double>, n long")
    for hot in (0, 3, 1000):
        monkeypatch.setattr(V, "HOT", hot)
        rows = V.token_vectors(docs, model)
        assert f"limit={hot}," in rows._jdf.queryExecution().executedPlan().toString() or not hot
        got = {r.doc_id: r.vec for r in mean_pool(rows, ["doc_id"]).collect()}
        assert got == {0: pytest.approx([4 / 3, 1.0]), 1: pytest.approx([3.0, 7 / 3]), 2: pytest.approx([0.5, 1.5])}
