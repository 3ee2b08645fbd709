import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sahaf.operators.ivf import assign_cells, ivf_search, nearest_cells, read_ivf, train_centroids, write_ivf
from sahaf.operators.lsh import approx_neighbors, fit_lsh, lsh_search
from sahaf.operators.nearest import recall_at_k, score_moments, top_k
from sahaf.operators.search import render_hits, search, with_texts
from sahaf.operators.embed import embed_with
from sahaf.operators.reduce import hashed_words, pca_reduce, word2vec_documents

DIM = 8
SMALL = {"broadcast_bytes": 1, "block_rows": 40}  # forces the block plan with many blocks


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    corpus = rng.normal(size=(300, DIM)).astype(np.float32)
    corpus[100:200] = corpus[50]  # a third of the rows are copies of one vector
    queries = np.vstack([corpus[50], rng.normal(size=(9, DIM))]).astype(np.float32)
    return corpus, queries


@pytest.fixture(scope="module")
def frames(spark, data):
    corpus, queries = data
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, vec array<float>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, query_vec array<float>")
    return c.repartition(5).cache(), q.cache()


def brute(data, k, metric, allowed=None):
    corpus, queries = (x.astype(np.float64) for x in data)
    out = []
    for qi, q in enumerate(queries):
        if metric == "l2":
            score = ((corpus - q) ** 2).sum(axis=1)
            order = np.lexsort((np.arange(len(corpus)), score))
        else:
            a, b = corpus, q
            if metric == "cosine":
                a = corpus / np.linalg.norm(corpus, axis=1)[:, None]
                b = q / np.linalg.norm(q)
            score = (a * b).sum(axis=1)
            order = np.lexsort((np.arange(len(corpus)), -score))
        if allowed is not None:
            order = [i for i in order if i in allowed[qi]]
        out += [(qi, r + 1, int(i), round(float(score[i]), 9)) for r, i in enumerate(order[:k])]
    return out


def rows(df):
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())


@pytest.mark.parametrize("metric", ["ip", "cosine", "l2"])
@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 3}, SMALL], ids=["broadcast", "slices", "blocks"])
def test_exact_search_equals_brute_force(frames, data, metric, options):
    assert rows(top_k(*frames, 7, metric, **options)) == brute(data, 7, metric)


def test_string_ids_and_short_corpus(spark):
    c = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None)], "id string, vec array<float>")
    q = spark.createDataFrame([("q", [2.0, 1.0])], "query_id string, query_vec array<float>")
    assert rows(top_k(c, q, 5)) == [("q", 1, "a", 2.0), ("q", 2, "b", 2.0)]
    assert top_k(c, q.limit(0), 5).count() == 0


def test_toy_vectors_by_lsh(spark):
    c = spark.createDataFrame(
        [(0, [0.1, 0.2, 0.3]), (1, [0.4, 0.5, 0.6]), (2, [0.7, 0.8, 0.9])], "id int, vec array<double>"
    )
    q = spark.createDataFrame([(0, [0.15, 0.25, 0.35])], "query_id int, query_vec array<double>")
    model = fit_lsh(c, 2.0, 3)
    found = lsh_search(model, c, q, 5).collect()
    expected = {0: 0.0866, 1: 0.4330, 2: 0.9526}
    assert len(found) <= 3 and found
    for r in found:
        assert r.distance == pytest.approx(expected[r.id], abs=1e-4)
    single = approx_neighbors(model, c, Vectors.dense([0.15, 0.25, 0.35]), 5).collect()
    assert {r.id for r in single} <= {r.id for r in found} | set(expected)


@pytest.mark.parametrize("options", [{}, SMALL], ids=["broadcast", "blocks"])
def test_lsh_equals_brute_force_over_shared_buckets(frames, data, options):
    c, q = frames
    model = fit_lsh(c, 0.8, 3)

    def tag(df, name):
        features = df.withColumn("features", array_to_vector(F.col(name).cast("array<double>")))
        hashed = model.transform(features).select(df.columns[0], "hashes").collect()
        return {r[0]: [h[0] for h in r[1]] for r in hashed}

    ch, qh = tag(c, "vec"), tag(q, "query_vec")
    allowed = {qi: {i for i in ch if any(a == b for a, b in zip(ch[i], qh[qi]))} for qi in qh}
    want = [(a, b, i, round(d**0.5, 6)) for a, b, i, d in brute(data, 4, "l2", allowed)]
    got = sorted((r[0], r[1], r[2], round(r[3], 6)) for r in lsh_search(model, c, q, 4, **options).collect())
    assert got == want


def test_ivf(spark, frames, data, tmp_path):
    c, q = frames
    centroids = train_centroids(c, nlist=6, seed=1).cache()
    index = assign_cells(c, centroids).cache()
    centre = np.array([r.centroid for r in centroids.orderBy("cell").collect()], dtype=np.float64)
    corpus, queries = data
    nearest = lambda x: ((centre[None] - x[:, None].astype(np.float64)) ** 2).sum(axis=2)
    cell = nearest(corpus).argmin(axis=1)
    assert [r.cell for r in index.orderBy("id").collect()] == cell.tolist()
    probes = np.argsort(nearest(queries), axis=1, kind="stable")
    recalls = []
    exact = top_k(c, q, 5).cache()
    for nprobe in (1, 3, 6):
        allowed = {i: set(np.flatnonzero(np.isin(cell, probes[i][:nprobe])).tolist()) for i in range(len(queries))}
        found = ivf_search(index, q, centroids, 5, nprobe)
        assert rows(found) == brute(data, 5, "ip", allowed)
        recalls.append(recall_at_k(found, exact).agg(F.avg("recall")).first()[0])
    assert recalls == sorted(recalls) and recalls[-1] == 1.0
    assert rows(ivf_search(index, q, centroids, 5, 3, **SMALL)) == rows(ivf_search(index, q, centroids, 5, 3))

    write_ivf(c, centroids, str(tmp_path / "ivf"))
    stored, stored_centroids = read_ivf(spark, str(tmp_path / "ivf"))
    again = ivf_search(stored, q, stored_centroids, 5, 3)
    assert rows(again) == rows(ivf_search(index, q, centroids, 5, 3))
    one = ivf_search(stored, q.limit(1), stored_centroids, 5, 1)
    plan = one._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ = ", plan)


def test_nlist_larger_than_corpus(frames):
    with pytest.raises(ValueError):
        train_centroids(frames[0], nlist=1000)


def test_nearest_cells_in_order(spark):
    cells = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [5.0])], "cell int, centroid array<float>")
    df = spark.createDataFrame([([0.9],)], "vec array<float>")
    assert df.select(nearest_cells(F.col("vec"), cells, 3)).first()[0] == [1, 0, 2]


@pytest.mark.parametrize("options", [{}, SMALL], ids=["broadcast", "blocks"])
def test_score_moments(frames, data, options):
    corpus, queries = (x.astype(np.float64) for x in data)
    score = corpus @ queries.T
    for r in score_moments(*frames, **options).collect():
        s = score[:, r.query_id]
        assert r.n == len(corpus)
        assert (r["mean"], r["std"], r["min"], r["max"]) == pytest.approx((s.mean(), s.std(), s.min(), s.max()))


def test_pca_keeps_most_variance(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 8)) + 0.01 * rng.normal(size=(200, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "id int, vec array<double>")
    got = np.array([r.reduced for r in pca_reduce(df, 4).orderBy("id").collect()])
    assert got.shape == (200, 4)
    assert got.var(axis=0)[:2].sum() == pytest.approx(base.var(axis=0).sum(), rel=1e-2)
    top = np.linalg.eigvalsh(np.cov(base.T))[::-1][:4]
    assert got.var(axis=0, ddof=1) == pytest.approx(top, abs=1e-6)


def test_word2vec_of_hashed_words(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a d e f"), (3, "a b g")], "doc_id int, text string")
    vectors = word2vec_documents(docs, size=6, partitions=1).collect()
    assert sorted(r.doc_id for r in vectors) == [1, 2, 3] and all(len(r.vec) == 6 for r in vectors)
    words = docs.select("doc_id", hashed_words(F.split("text", " "), 4).alias("words"))
    got = {r.doc_id: r.words for r in words.collect()}
    assert got[1][0] == got[1][2] == got[2][1] == got[3][0]
    assert {i: len(w) for i, w in got.items()} == {1: 4, 2: 5, 3: 3}
    assert {w for ws in got.values() for w in ws} <= {"0", "1", "2", "3"}


def test_centroids_of_all_rows_or_a_stated_share(spark):
    vectors = spark.range(3000).selectExpr("id", "array(float(id % 4), float(id % 3)) AS vec")
    assert train_centroids(vectors, nlist=2).count() == train_centroids(vectors, nlist=2, share=0.5).count() == 2


def test_moments_pass_over_non_finite_vectors(spark):
    corpus = spark.createDataFrame([(0, [1.0, 0.0]), (1, [float("nan"), 1.0]), (2, [3.0, 0.0])], "id long, vec array<double>")
    asked = spark.createDataFrame([(7, [1.0, 1.0])], "query_id long, query_vec array<double>")
    row = score_moments(corpus, asked).first()
    assert (row.n, row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)


def test_hits_leave_the_texts_where_they_are(spark, monkeypatch):
    hits = spark.createDataFrame([(1, 1, 5, 0.5)], "query_id long, rank int, id long, score double")
    docs = spark.range(100).selectExpr("id", "concat('t', id) AS text")
    sent = with_texts(hits, docs)
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString() and sent.first().text == "t5"
    monkeypatch.setattr("sahaf.operators.search.MAX_SENT_HITS", 0)
    assert with_texts(hits, docs).first().text == "t5"


def test_failing_texts_have_their_error(spark):
    def make():
        def encode(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [[len(t), 0.5] for t in texts]

        return encode

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, "d")], "id long, text string").coalesce(1)
    got = {r.id: (r.vec, r.error) for r in embed_with(df, make, error_col="error").collect()}
    assert got == {1: ([3.0, 0.5], None), 2: (None, "ValueError: no"), 3: ([1.0, 0.5], None)}
    with pytest.raises(Exception, match="no"):
        embed_with(df, make).collect()


def test_search_entry_point_and_rendering(spark, frames):
    c, q = frames
    exact = search(q, c, "cosine", 3)
    assert rows(exact) == rows(top_k(c, q, 3, "cosine"))
    centroids = train_centroids(c, nlist=4)
    index = assign_cells(c, centroids)
    assert rows(search(q, index, k=3, method="ivf", centroids=centroids, nprobe=4)) == rows(top_k(c, q, 3))
    assert search(q, c, k=3, method="lsh").count() > 0
    with pytest.raises(ValueError):
        search(q, c, method="other")
    docs = c.select("id", F.concat(F.lit("text "), "id").alias("text"))
    shown = render_hits(exact, docs, length=5).where("query_id = 0 AND rank = 1").first()
    assert (shown.id, shown.score, shown.preview) == (50, "1.000", "text ...")
