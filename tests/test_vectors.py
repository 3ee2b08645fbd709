import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.functions import vectors as V
from sahaf.operators.pooling import _batch_means, mean_pool


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} array<float>" for k in values))
    return row.select(column.alias("x")).first()[0]


def test_products_and_distances(spark):
    a, b = F.col("a"), F.col("b")
    args = {"a": [1.0, 2.0, 2.0], "b": [2.0, 0.0, 1.0]}
    assert one(spark, V.dot(a, b), **args) == 4.0
    assert one(spark, V.norm(a), **args) == 3.0
    assert one(spark, V.cosine(a, b), **args) == pytest.approx(4 / (3 * math.sqrt(5)))
    assert one(spark, V.l2_squared(a, b), **args) == 6.0
    assert one(spark, V.euclidean(a, b), **args) == pytest.approx(math.sqrt(6))


def test_normalize_keeps_zero_vector(spark):
    assert one(spark, V.normalize(F.col("a")), a=[0.0, 0.0]) == [0.0, 0.0]
    unit = one(spark, V.normalize(F.col("a")), a=[3.0, 4.0])
    assert unit == pytest.approx([0.6, 0.8])
    assert one(spark, V.cosine(F.col("a"), F.col("b")), a=[0.0, 0.0], b=[1.0, 0.0]) == 0.0


def test_mean_pool_of_token_vectors(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 6.0]]), (2, [])], "id int, v array<array<float>>")
    got = {r[0]: r[1] for r in df.select("id", V.mean_pool(F.col("v"))).collect()}
    assert got == {1: [2.0, 4.0], 2: None}


def test_mean_pool_over_rows(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "k string, vec array<float>")
    assert {r.k: r.vec for r in mean_pool(df, ["k"]).collect()} == {"a": [2.0, 4.0], "b": [5.0, 5.0]}


def test_dense_from_entries(spark):
    df = spark.createDataFrame(
        [(1, [(1, 5.0), (4, 7.0)]), (2, []), (3, [(0, 1.0), (5, 2.0)])],
        "id int, e array<struct<pos int, value double>>",
    )
    got = {r[0]: r[1] for r in df.select("id", V.dense_from_entries(F.col("e"), 6)).collect()}
    assert got[1] == [0, 5, 0, 0, 7, 0]
    assert got[2] == [0] * 6
    assert got[3] == [1, 0, 0, 0, 0, 2]


@pytest.mark.parametrize("kind", ["float", "int", "double"])
def test_many_keys_are_combined_in_batches_first(spark, kind):
    rng = np.random.default_rng(4)
    rows = [(int(k) if k else None, {"s": int(k) % 2}, rng.integers(0, 9, 3).tolist()) for k in rng.integers(0, 400, 3000)]
    df = spark.createDataFrame(rows, f"k long, half map<string, int>, vec array<int>").selectExpr("k", "half['s'] AS _n_", f"CAST(vec AS array<{kind}>) AS vec")
    df = df.withColumn("s", F.struct("_n_"))
    for keys in (["k"], ["_n_", "k"], ["s"]):
        want = {tuple(r[:-1]): r.vec for r in mean_pool(df, keys).collect()}
        got = {tuple(r[:-1]): pytest.approx(r.vec) for r in mean_pool(df, keys, many=True).collect()}
        assert want == got
    partial = _batch_means(df.orderBy("k").coalesce(1), ["k"], "vec")
    assert partial.count() <= 401 and partial.selectExpr("sum(_n)").first()[0] == 3000
    odd = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (1, [3.0])], "k long, vec array<float>").coalesce(1)
    assert {r.k: r.vec for r in mean_pool(odd, ["k"], many=True).collect()} == {1: [2.0], 2: [1.0, 2.0]}
