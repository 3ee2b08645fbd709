"""K-means steps, the tree of centroids, split cells and multi-probe hashing against NumPy."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.operators.ivf import assign_cells
from sahaf.operators.kmeans import assign_by_tree, centroid_tree, fit_cells, seed_centroids, split_cells
from sahaf.operators.nearest import recall_at_k, top_k
from sahaf.operators.probing import fit_probing, hash_numbers, probe_search, scored_share

SCHEMA = "id bigint, vec array<double>"


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(40, 12)) * 2
    return np.concatenate([m + rng.normal(size=(50, 12)) * 0.4 for m in middles])


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    rows += [(9000, None), (9001, []), (9002, [float("nan")] * 12), (9003, [None] * 12)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def brute_cells(points, n, steps):
    order = sorted(range(len(points)), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    centre = points[order[:n]].copy()
    for step in range(steps + 1):
        cell = ((points[:, None] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        if step < steps:
            centre = np.array([points[cell == c].mean(axis=0) if (cell == c).any() else centre[c] for c in range(n)])
    return centre, cell


def table(centroids):
    rows = centroids.orderBy("cell").collect()
    return [r.cell for r in rows], np.array([r.centroid for r in rows])


def test_lloyd_steps_equal_numpy(vectors, points):
    want, cell = brute_cells(points, 25, 4)
    centroids = fit_cells(vectors, 25, 4)
    names, got = table(centroids)
    assert names == list(range(25)) and np.allclose(got, want, atol=1e-9)
    found = assign_cells(vectors.where("id < 9000"), centroids).orderBy("id").collect()
    assert [r.cell for r in found] == cell.tolist()


def test_few_or_no_vectors(spark, vectors):
    assert fit_cells(vectors.where("id < 3"), 8, 2).count() == 3
    none = fit_cells(vectors.where("id > 8999"), 8, 2)
    assert none.count() == 0
    assert centroid_tree(none).count() == 0


def test_tree_finds_nearly_all_and_a_full_beam_all(vectors, points):
    whole = vectors.where("id < 9000")
    centroids = fit_cells(vectors, 36, 4)
    flat = {r.id: r.cell for r in assign_cells(whole, centroids).collect()}
    tree = centroid_tree(centroids).cache()
    assert tree.select("group").distinct().count() <= 6 and tree.count() == 36
    for beam, least in ((1, 0.8), (2, 0.9), (6, 1.0)):
        found = {r.id: r.cell for r in assign_by_tree(whole, tree, beam).collect()}
        assert np.mean([found[i] == c for i, c in flat.items()]) >= least, beam
    _, by_tree = table(fit_cells(vectors, 36, 4, branch=6, beam=6))
    assert np.allclose(by_tree, table(centroids)[1], atol=1e-9)


def test_split_cells(spark, vectors, points):
    whole = vectors.where("id < 9000")
    centroids = fit_cells(vectors, 10, 2)
    before = {r[0]: r[1] for r in assign_cells(whole, centroids).groupBy("cell").count().collect()}
    after = split_cells(vectors, centroids, 150)
    names, _ = table(after)
    more = sum(-(-n // 150) - 1 for n in before.values())
    assert more and names == list(range(10 + more))
    sizes = assign_cells(whole, after).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert sizes < max(before.values())
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], SCHEMA)
    one = split_cells(copies, seed_centroids(copies, 1), 10)
    assert [r.cell for r in one.collect()] == [0]
    assert split_cells(vectors, centroids, 10**6) is centroids


def test_probing_reaches_the_recall_on_few_rows(spark, vectors, points):
    rng = np.random.default_rng(2)
    asked = points[rng.choice(len(points), 60, replace=False)] + rng.normal(size=(60, 12)) * 0.05
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id bigint, query_vec array<double>")
    model = fit_probing(vectors, 5)
    exact = top_k(vectors.where("id < 9000"), queries, 5, "l2")
    found = probe_search(model, vectors, queries, 5)
    assert recall_at_k(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    shares = scored_share(model, vectors, queries).collect()
    assert len(shares) == 60 and np.mean([r.share for r in shares]) < 0.3
    # Against the buckets, by hand.
    own, probed = model.own_cells(points), model.probe_cells(asked)
    assert len({tuple(sorted(p)) for p in probed.tolist()}) > 1 and probed.shape == (60, model.tables * model.probes)
    for r in shares:
        assert r.share == pytest.approx(np.isin(own, probed[r.query_id]).any(axis=1).mean())
    # The unmoved buckets come first.
    assert all(set(model.own_cells(asked[i : i + 1])[0]) <= set(probed[i]) for i in range(60))
    numbers = {(r.id, r.tbl): r.numbers for r in hash_numbers(model, vectors).where("id < 5").collect()}
    place = np.floor(model.places(points[:5])).astype(int)
    assert all(numbers[i, t] == place[i, t].tolist() for i in range(5) for t in range(model.tables))


def test_probing_of_small_tables(spark, vectors):
    none = vectors.where("id > 8999")
    queries = spark.createDataFrame([(1, [0.0] * 12), (2, None)], "query_id bigint, query_vec array<double>")
    model = fit_probing(vectors.where("id < 1"), 5)
    assert probe_search(model, none, queries).count() == 0
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(20)], SCHEMA)
    asked = spark.createDataFrame([(1, [1.0, 1.0])], "query_id bigint, query_vec array<double>")
    assert [r.id for r in probe_search(fit_probing(same, 3), same, asked, 3).orderBy("rank").collect()] == [0, 1, 2]
