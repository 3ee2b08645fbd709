"""Inverted-file search: vectors grouped by nearest centroid, few cells probed.

The centroid table is the only thing broadcast. Its size is fixed by ``nlist`` and
checked against ``MAX_CENTROID_BYTES``.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.operators.nearest import bounded_table, top_k, unit_rows, vector_matrix
from sahaf.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The centroid table is held by every task; a larger one is refused.
MAX_CENTROID_BYTES = 1 << 30


def train_centroids(
    vectors: DataFrame, nlist: int = 1024, seed: int = 42, max_iter: int = 10, share: float = 1.0
) -> DataFrame:
    """K-means centroids (cell int, centroid array<float>) of ``vectors(id, vec)``.

    Trained on all rows, or on the ``share`` of them that the caller states, chosen by a
    hash of the id. ``nlist`` must not exceed the number of rows.
    """
    rows = vectors.count()
    if nlist > rows:
        raise ValueError(f"nlist={nlist} exceeds the {rows} vectors")
    training = vectors
    if share < 1.0:
        training = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    training = training.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter).fit(training)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(centers, "cell int, centroid array<float>")


def nearest_cells(vec: Column, centroids: DataFrame, n: int = 1, metric: str = "l2") -> Column:
    """The ``n`` nearest cells of a vector, nearest first, ties to the smaller cell."""
    table = bounded_table(
        centroids.select("cell", F.col("centroid").cast("array<double>").alias("centroid")),
        MAX_CENTROID_BYTES // 8,
        MAX_CENTROID_BYTES,
    )
    if table is None:
        raise ValueError("too many centroids to hold in memory")
    table = table.sort_by("cell")
    cells = table.column("cell").to_numpy().astype(np.int64)
    matrix = vector_matrix(table.column("centroid"))
    if metric == "cosine":
        matrix = unit_rows(matrix)
    shared = centroids.sparkSession.sparkContext.broadcast((cells, matrix))

    @F.arrow_udf("array<bigint>")
    def rank_cells(column: pa.Array) -> pa.Array:
        names, c = shared.value
        take = min(n, len(names))
        x = vector_matrix(column)
        picked = np.empty((len(x), take), dtype=np.int64)
        step = max(1, 4_000_000 // max(len(names), 1))
        for at in range(0, len(x), step):
            score = x[at : at + step] @ c.T
            if metric == "l2":
                score = 2.0 * score - (c * c).sum(axis=1)
            if take == 1:
                best = score.argmax(axis=1)[:, None]
            else:
                best = np.argsort(-score, axis=1, kind="stable")[:, :take]
            picked[at : at + step] = names[best]
        offsets = pa.array(np.arange(0, len(x) * take + 1, take, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(picked.ravel()))

    return rank_cells(vec)


def assign_cells(vectors: DataFrame, centroids: DataFrame, metric: str = "l2") -> DataFrame:
    """Add ``cell int``, the nearest centroid of ``vec``."""
    return vectors.withColumn("cell", nearest_cells(F.col("vec"), centroids, 1, metric)[0].cast("int"))


def write_ivf(vectors: DataFrame, centroids: DataFrame, path: str, metric: str = "l2") -> None:
    """Write the corpus partitioned by cell, and the centroids next to it.

    The rebalance hint merges small cells into few files and splits a crowded cell
    over several tasks.
    """
    assigned = assign_cells(vectors, centroids, metric)
    assigned.hint("rebalance", F.col("cell")).write.partitionBy("cell").mode("errorifexists").parquet(
        f"{path}/vectors"
    )
    centroids.write.mode("errorifexists").parquet(f"{path}/centroids")


def read_ivf(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors with ``cell``, centroids) written by :func:`write_ivf`."""
    return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/centroids")


def ivf_search(
    index: DataFrame,
    queries: DataFrame,
    centroids: DataFrame,
    k: int = 5,
    nprobe: int = 10,
    metric: str = "ip",
    cell_metric: str = "l2",
    **options,
) -> DataFrame:
    """``top_k`` over the ``nprobe`` cells nearest to each query.

    The probed cells become a literal filter on the partition column, so only their
    folders are read.
    """
    vec = F.col("query_vec").cast("array<double>")
    probes = queries.select(
        "query_id", "query_vec", nearest_cells(vec, centroids, nprobe, cell_metric).alias("query_cells")
    )
    probes = staged(probes, "probes")  # read for the cells and again for the scores
    probed = [r[0] for r in probes.select(F.explode("query_cells")).distinct().collect()]  # <= nlist
    corpus = index.where(F.col("cell").isin(probed)).withColumn(
        "cells", F.array(F.col("cell").cast("bigint"))
    )
    return top_k(corpus, probes, k, metric, cells=True, **options)
