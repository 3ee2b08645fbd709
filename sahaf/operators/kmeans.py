"""K-means cells by Lloyd steps on DataFrames, with a tree of centroids for many cells.

Seeds are the vectors whose ids have the first MD5 sums, so reruns and other engines start
alike. A step assigns every vector to its nearest centroid and takes the mean of each cell;
means are combined before the shuffle, so a cell with a third of all rows costs one partial
vector per task. A cell without vectors keeps its centroid. Vectors that are null, or hold
nulls or numbers that are not finite, belong to no cell.

With a tree, a vector is compared with about ``sqrt(nlist)`` groups of centroids and then
with the members of the ``beam`` nearest groups, not with all centroids.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sahaf.operators.ivf import MAX_CENTROID_BYTES, assign_cells
from sahaf.operators.nearest import bounded_table, vector_matrix
from sahaf.operators.pooling import mean_pool
from sahaf.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose ``vec`` is whole: not null or empty, every component finite."""
    finite = F.forall(F.col("vec").cast("array<double>"), lambda x: F.abs(x) < float("inf"))
    return vectors.where((F.size("vec") > 0) & finite)


def _order() -> list[Column]:
    return [F.md5(F.col("id").cast("string")), F.col("id")]


def seed_centroids(vectors: DataFrame, n: int) -> DataFrame:
    """``n`` seeds (cell int, centroid array<double>) of ``vectors(id, vec)``, in the order of the ids' MD5 sums."""
    first = usable(vectors).orderBy(*_order()).limit(n)
    cell = F.row_number().over(W.orderBy(*_order())) - 1
    return staged(first.select(cell.alias("cell"), F.col("vec").cast("array<double>").alias("centroid")), "seeds")


def lloyd_step(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """The mean of each cell of ``assigned(cell, vec)``, or its centroid where it is empty."""
    means = mean_pool(assigned, ["cell"]).withColumnRenamed("vec", "mean")
    moved = centroids.join(means, "cell", "left").select("cell", F.coalesce("mean", "centroid").alias("centroid"))
    return staged(moved, "centroids")


def fit_cells(vectors: DataFrame, nlist: int, steps: int = 10, branch: int | None = None, beam: int = 2) -> DataFrame:
    """Centroids (cell int, centroid array<double>) of ``vectors(id, vec)`` after ``steps`` Lloyd steps.

    With ``branch`` the vectors find their cells through a tree of that many groups, made
    anew from the centroids in each step. Fewer than ``nlist`` vectors give a cell each.
    """
    rows = usable(vectors).select("vec")
    centroids = seed_centroids(vectors, nlist)
    for _ in range(steps):
        if branch is None:
            assigned = assign_cells(rows, centroids)
        else:
            assigned = assign_by_tree(rows, centroid_tree(centroids, branch, steps), beam)
        centroids = lloyd_step(assigned, centroids)
    return centroids


def centroid_tree(centroids: DataFrame, branch: int | None = None, steps: int = 10) -> DataFrame:
    """(cell, centroid, group, group_centroid): the centroids as members of ``branch`` groups.

    The groups are cells of the centroids themselves; ``sqrt`` of their number by default.
    """
    branch = branch or max(1, math.isqrt(centroids.count()))
    nodes = centroids.select(F.col("cell").alias("id"), F.col("centroid").alias("vec"))
    groups = fit_cells(nodes, branch, steps)
    named = assign_cells(nodes, groups).select(F.col("id").alias("cell"), F.col("vec").alias("centroid"), F.col("cell").alias("group"))
    groups = groups.select(F.col("cell").alias("group"), F.col("centroid").alias("group_centroid"))
    return staged(named.join(groups, "group").select("cell", "centroid", "group", "group_centroid"), "centroid-tree")


def tree_cells(vec: Column, tree: DataFrame, beam: int = 2) -> Column:
    """The nearest cell of a vector among the members of its ``beam`` nearest groups; ties to the smaller number."""
    table = bounded_table(tree.select("cell", "centroid", "group", "group_centroid"), MAX_CENTROID_BYTES // 8, MAX_CENTROID_BYTES)
    if table is None:
        raise ValueError("too many centroids to hold in memory")
    table = table.sort_by([("group", "ascending"), ("cell", "ascending")])
    group = table.column("group").to_numpy()
    firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    shared = tree.sparkSession.sparkContext.broadcast((
        table.column("cell").to_numpy().astype(np.int64),
        vector_matrix(table.column("centroid")),
        np.append(firsts, len(group)),
        vector_matrix(table.column("group_centroid").take(pa.array(firsts))),
    ))

    @F.arrow_udf("bigint")
    def nearest(column: pa.Array) -> pa.Array:
        cells, members, begin, tops = shared.value
        x = vector_matrix(column)
        found, best = np.full(len(x), -1, np.int64), np.full(len(x), -np.inf)
        if not len(x) or not len(cells):
            return pa.array(found, mask=found < 0)
        near = np.argsort((tops * tops).sum(axis=1) - 2.0 * (x @ tops.T), axis=1, kind="stable")[:, :beam]
        rows, asked = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()
        order = np.argsort(asked, kind="stable")
        names, at = np.unique(asked[order], return_index=True)
        for g, own in zip(names, np.split(rows[order], at[1:]), strict=True):
            a, b = begin[g], begin[g + 1]
            score = 2.0 * (x[own] @ members[a:b].T) - (members[a:b] ** 2).sum(axis=1)
            first = score.argmax(axis=1)
            value, cell = score[np.arange(len(own)), first], cells[a:b][first]
            better = (value > best[own]) | ((value == best[own]) & (cell < found[own]))
            best[own[better]], found[own[better]] = value[better], cell[better]
        return pa.array(found, mask=found < 0)

    return nearest(vec)


def assign_by_tree(vectors: DataFrame, tree: DataFrame, beam: int = 2) -> DataFrame:
    """Add ``cell int``, the cell that the tree finds for ``vec``."""
    return vectors.withColumn("cell", tree_cells(F.col("vec"), tree, beam).cast("int"))


def split_cells(vectors: DataFrame, centroids: DataFrame, most: int, steps: int = 1) -> DataFrame:
    """Centroids with more cells where one has over ``most`` vectors.

    Such a cell gets as many seeds as it has ``most`` vectors, begun ones too, from its own
    vectors in the order of the ids' MD5 sums; then come ``steps`` Lloyd steps. Equal seeds
    are one, so a cell of copies of one vector stays whole. The other cells keep their numbers.
    """
    assigned = staged(assign_cells(usable(vectors).select("id", "vec"), centroids), "cells")
    sizes = assigned.groupBy("cell").count().where(F.col("count") > most)
    parts = staged(sizes.select("cell", F.ceil(F.col("count") / most).cast("int").alias("parts")), "crowded")
    greatest = parts.agg(F.max("parts")).first()[0]  # one row per crowded cell
    if greatest is None:
        return centroids
    rank = F.row_number().over(W.partitionBy("cell").orderBy(*_order()))
    # The literal bound lets each task pass on only its own first rows of a cell.
    chosen = assigned.join(F.broadcast(parts.select("cell")), "cell", "left_semi").withColumn("rank", rank).where(F.col("rank") <= greatest)
    chosen = chosen.join(parts, "cell").where(F.col("rank") <= F.col("parts"))
    seeds = chosen.groupBy("cell", F.col("vec").cast("array<double>").alias("centroid")).agg(F.min("rank").alias("rank"))
    last = centroids.agg(F.max("cell")).first()[0]
    fresh = F.row_number().over(W.orderBy(F.col("rank") == 1, "cell", "rank"))
    # The first seed of a cell takes its number, the others follow the last one.
    order = F.when(F.col("rank") == 1, F.col("cell")).otherwise(F.lit(last) + fresh)
    kept = centroids.join(parts, "cell", "left_anti").select("cell", "centroid")
    centroids = staged(kept.unionByName(seeds.select(order.alias("cell"), "centroid")), "centroids")
    rows = assigned.select("vec")
    for _ in range(steps):
        centroids = lloyd_step(assign_cells(rows, centroids), centroids)
    return centroids
