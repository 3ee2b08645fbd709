"""Approximate neighbours by random-projection hashing."""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.operators.nearest import top_k


def fit_lsh(
    vectors: DataFrame, bucket_length: float = 2.0, tables: int = 3, seed: int = 42
) -> BucketedRandomProjectionLSHModel:
    """Fit on ``vectors(vec)``; only the dimension is read from the data."""
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    return lsh.fit(_features(vectors, "vec"))


def _features(df: DataFrame, vec_col: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vec_col).cast("array<double>")))


def _buckets(hashes: Column, tables: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), vector_to_array(hashes[i])[0]) for i in range(tables)])


def lsh_search(
    model: BucketedRandomProjectionLSHModel, corpus: DataFrame, queries: DataFrame, k: int = 5, **options
) -> DataFrame:
    """``k`` nearest rows by Euclidean distance among those sharing a bucket with the
    query in some table: (query_id, rank, id, distance). May return fewer than ``k``.
    """
    tables = model.getNumHashTables()
    hashed = model.transform(_features(corpus, "vec"))
    probes = model.transform(_features(queries, "query_vec"))
    hits = top_k(
        hashed.withColumn("cells", _buckets(F.col("hashes"), tables)),
        probes.withColumn("query_cells", _buckets(F.col("hashes"), tables)),
        k,
        "l2",
        cells=True,
        **options,
    )
    return hits.select("query_id", "rank", "id", F.sqrt("score").alias("distance"))


def approx_neighbors(
    model: BucketedRandomProjectionLSHModel, corpus: DataFrame, key: Vector, k: int = 5
) -> DataFrame:
    """The single-query form: the corpus rows nearest to ``key`` with ``distCol``."""
    return model.approxNearestNeighbors(_features(corpus, "vec"), key, k).drop("features", "hashes")
