"""Multi-probe hashing: buckets of random projections, probed in the order of their distance.

A table hashes a vector to ``bits`` whole numbers, its projections divided by the bucket
width. A query also looks into neighbouring buckets, those first whose boundaries lie
nearest to it. Width and number of probes are fitted: on a sample of stated size, the pair
with the smallest share of scored rows that reaches the recall asked for. All rows are hashed.

Projections come from MD5 sums, so they can be stated in any engine. Vectors that are null
or hold nulls or numbers that are not finite are in no bucket.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.operators.kmeans import usable
from sahaf.operators.nearest import bounded_table, cell_lists, top_k, vector_matrix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of the sample that width and probes are fitted on, and how many of them ask.
SAMPLE, ASKING = 4_096, 128
#: Probes a table that are tried, and the steps between widths.
PROBES, WIDTH_STEP = (1, 2, 4, 8, 16, 32), 1.25


def projections(rows: int, dim: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Normal numbers (rows x dim) and one uniform number a row, from MD5 sums of ``seed:row:position``."""

    def uniform(row: int, at: int) -> tuple[float, float]:
        digits = hashlib.md5(f"{seed}:{row}:{at}".encode(), usedforsecurity=False).hexdigest()
        return tuple((int(digits[i : i + 8], 16) + 0.5) / 4294967296.0 for i in (0, 8))

    pairs = np.array([[uniform(r, i) for i in range(dim + 1)] for r in range(rows)]).reshape(rows, dim + 1, 2)
    normal = np.sqrt(-2.0 * np.log(pairs[:, :dim, 0])) * np.cos(2.0 * np.pi * pairs[:, :dim, 1])
    return normal, pairs[:, dim, 0]


@dataclass(frozen=True)
class Probing:
    """``tables`` of ``bits`` hash numbers each, buckets of ``width``, and ``probes`` a table for a query."""

    planes: np.ndarray
    shifts: np.ndarray
    tables: int
    bits: int
    width: float
    probes: int

    def places(self, x: np.ndarray) -> np.ndarray:
        """Projections in units of the width: vectors x tables x bits."""
        return (x @ self.planes.T / self.width + self.shifts).reshape(len(x), self.tables, self.bits)

    def keys(self, table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """One number for the hash numbers (.. x bits) of a table."""
        out = np.broadcast_to(table + 1, numbers.shape[:-1]).astype(np.uint64)
        for j in range(self.bits):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + numbers[..., j].astype(np.int64).view(np.uint64)
        return out.view(np.int64)

    def own_cells(self, x: np.ndarray) -> np.ndarray:
        return self.keys(np.arange(self.tables), np.floor(self.places(x)))

    def probe_cells(self, x: np.ndarray) -> np.ndarray:
        """Cells of each vector's ``tables * probes`` best buckets, the nearest first.

        A bucket is a step of -1, 0 or 1 for each hash number; its cost is the sum of the
        squared distances to the boundaries that are crossed.
        """
        moves = np.array(list(itertools.product((0, -1, 1), repeat=self.bits)))
        place = self.places(x)
        whole = np.floor(place)
        below = (place - whole) ** 2
        above = (1.0 - (place - whole)) ** 2
        cost = below @ (moves == -1).T + above @ (moves == 1).T  # vectors x tables x moves
        flat = cost.reshape(len(x), -1)
        best = np.argsort(flat, axis=1, kind="stable")[:, : self.tables * self.probes]
        table, move = best // len(moves), best % len(moves)
        numbers = np.take_along_axis(whole, table[..., None], axis=1) + moves[move]
        return self.keys(table, numbers)


def _lists(cells: np.ndarray) -> pa.Array:
    offsets = np.arange(len(cells) + 1, dtype=np.int32) * (cells.shape[1] if cells.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cells.ravel()))


def _cells(model: Probing, vec: Column, probe: bool) -> Column:
    @F.arrow_udf("array<bigint>")
    def hashed(column: pa.Array) -> pa.Array:
        x = vector_matrix(column)
        if not len(x):
            return pa.array([], pa.list_(pa.int64()))
        if not probe:
            return _lists(model.own_cells(x))
        step = max(1, 2_000_000 // (model.tables * 3**model.bits))
        return _lists(np.concatenate([model.probe_cells(x[i : i + step]) for i in range(0, len(x), step)]))

    return hashed(vec)


def shares_and_recalls(model: Probing, corpus: np.ndarray, asking: np.ndarray, exact: np.ndarray) -> tuple[float, float]:
    """Mean share of ``corpus`` that shares a bucket with a row of it, and share of its ``exact`` neighbours there."""
    own = model.own_cells(corpus)
    probed = model.probe_cells(corpus[asking])
    scored = found = 0
    for i, row in enumerate(asking):
        there = np.isin(own, probed[i]).any(axis=1)
        there[row] = False
        scored += there.sum()
        found += there[exact[i]].sum()
    return scored / (len(asking) * max(1, len(corpus) - 1)), found / max(1, exact.size)


def fit_probing(vectors: DataFrame, k: int = 5, recall: float = 0.95, tables: int = 8, bits: int = 4, seed: int = 0) -> Probing:
    """Fit width and probes for the ``k`` nearest rows of ``vectors(id, vec)``.

    At most SAMPLE vectors, those whose ids have the first MD5 sums, are looked at; ASKING of
    them ask for their neighbours in the sample. In the whole corpus neighbours are nearer,
    so the recall there is no lower for queries like its rows. Where no pair reaches the
    recall, the one with the greatest is taken; a corpus of fewer than two rows gets a width of 1.
    """
    first = usable(vectors).orderBy(F.md5(F.col("id").cast("string")), "id").limit(SAMPLE)
    x = vector_matrix(first.select(F.col("vec").cast("array<double>").alias("vec")).toArrow().column("vec"))
    dim = x.shape[1] if len(x) else 1
    planes, shifts = projections(tables * bits, dim, seed)
    model = Probing(planes, shifts, tables, bits, 1.0, 1)
    if len(x) < 2:
        return model
    asking, k = np.arange(min(ASKING, len(x))), min(k, len(x) - 1)
    squares = (x * x).sum(axis=1)
    distance = squares[asking, None] + squares[None] - 2.0 * (x[asking] @ x.T)
    distance[asking, asking] = np.inf
    exact = np.argsort(distance, axis=1, kind="stable")[:, :k]
    near = float(np.sqrt(np.maximum(np.median(np.take_along_axis(distance, exact, 1)), 0.0))) or 1.0
    best = None
    for i in range(-8, 9):
        for probes in PROBES:
            tried = replace(model, width=near * WIDTH_STEP**i, probes=min(probes, 3**bits))
            share, got = shares_and_recalls(tried, x, asking, exact)
            rank = (got < recall, share if got >= recall else -got, share)
            if best is None or rank < best[0]:
                best = rank, tried
            if got >= recall:
                break  # more probes only score more
    return best[1]


def probe_search(model: Probing, corpus: DataFrame, queries: DataFrame, k: int = 5, **options) -> DataFrame:
    """The ``k`` nearest rows by Euclidean distance among those in a probed bucket: (query_id, rank, id, distance)."""
    hashed = usable(corpus).withColumn("cells", _cells(model, F.col("vec"), False))
    hits = top_k(hashed, _probed(model, queries), k, "l2", cells=True, **options)
    return hits.select("query_id", "rank", "id", F.sqrt("score").alias("distance"))


def _probed(model: Probing, queries: DataFrame) -> DataFrame:
    whole = F.forall(F.col("query_vec").cast("array<double>"), lambda x: F.abs(x) < float("inf"))
    asked = queries.where((F.size("query_vec") > 0) & whole)
    return asked.withColumn("query_cells", _cells(model, F.col("query_vec"), True))


def scored_share(model: Probing, corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """The share of all rows that a query's probes meet: (query_id, share).

    Tasks pass on a count per query. The queries must be few enough to be sent.
    """
    probes = bounded_table(_probed(model, queries).select("query_id", "query_cells"), 8_192, 64 << 20)
    if probes is None:
        raise ValueError("too many queries to count for at once")
    asks, cells = cell_lists(probes.column("query_cells"))
    order = np.argsort(cells, kind="stable")
    shared = corpus.sparkSession.sparkContext.broadcast((cells[order], asks[order], len(probes)))

    def count(batches):
        names, owners, n = shared.value
        total, rows = np.zeros(n, np.int64), 0
        for batch in batches:
            row, cell = cell_lists(batch.column(0))
            low, high = np.searchsorted(names, cell, "left"), np.searchsorted(names, cell, "right")
            width = high - low
            at = np.repeat(low, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            pairs = np.unique(np.repeat(row, width) * n + owners[at])
            total += np.bincount(pairs % n, minlength=n) if n else 0
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total), pa.array(np.full(n, rows))], names=["q", "n", "rows"])

    hashed = usable(corpus).select(_cells(model, F.col("vec"), False).alias("cells"))
    counts = hashed.mapInArrow(count, "q bigint, n bigint, rows bigint").groupBy("q").agg((F.sum("n") / F.sum("rows")).alias("share"))
    ids = corpus.sparkSession.createDataFrame(pa.table({"q": pa.array(np.arange(len(probes))), "query_id": probes.column("query_id")}))
    return ids.join(counts, "q").select("query_id", "share")


def hash_numbers(model: Probing, vectors: DataFrame) -> DataFrame:
    """Every vector's hash numbers: (id, tbl, numbers array<bigint>)."""

    @F.arrow_udf("array<bigint>")
    def numbers(column: pa.Array) -> pa.Array:
        x = vector_matrix(column)
        if not len(x):
            return pa.array([], pa.list_(pa.int64()))
        return _lists(np.floor(model.places(x)).astype(np.int64).reshape(len(x), -1))

    rows = usable(vectors).select("id", numbers(F.col("vec")).alias("all"))
    table = F.explode(F.sequence(F.lit(0), F.lit(model.tables - 1))).alias("tbl")
    return rows.select("id", "all", table).select("id", "tbl", F.slice("all", F.col("tbl") * model.bits + 1, model.bits).alias("numbers"))
