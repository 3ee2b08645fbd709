"""Exact and cell-restricted nearest-neighbour search over a large corpus.

The corpus is scanned where it lies: every task scores its own Arrow batches
against the query matrix and keeps ``k`` rows per query, so a task hands on at
most ``k * queries`` rows and the corpus itself is never shuffled. A window with
``row_number() <= k`` then merges the tasks' hits.

The query matrix is broadcast only after it was found to be within
``broadcast_bytes``. A query set of a few times that size is sliced, one scan per slice.
A larger one takes the block plan: both sides are cut into hashed blocks, every block pair is one co-group of bounded size, and the same
kernel runs on each pair.

``cells`` restricts which pairs are scored (inverted file, hash buckets): a corpus
row and a query are compared when their cell lists share an entry. A crowded cell
stays spread over the file splits (or blocks) that hold it.

Equal scores are ordered by id. Scores are recomputed row by row after the matrix
product has selected candidates, so copies of one vector get the same score.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sahaf.session import staged

# Executors need numpy and pyarrow only: the kernel travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("ip", "cosine", "l2")
SCORE_CELLS = 4_000_000  # scores held at once by one task
RESCORE_VALUES = 4_000_000  # vector components gathered at once when rescoring
MAX_QUERY_ROWS = 8_192  # 64 MB of 1024-d doubles
MAX_SLICES = 16


@dataclass
class QueryBlock:
    """Queries of one task: row ``i`` of ``matrix`` belongs to ``ids[i]``."""

    ids: pa.Array
    matrix: np.ndarray
    members: dict[int, np.ndarray] | None  # cell -> query rows


def vector_matrix(column: pa.Array) -> np.ndarray:
    """float64 matrix of an Arrow list column whose rows share one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    rows = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if rows == 0:
        return np.zeros((0, 0))
    if column.null_count or len(values) % rows:
        raise ValueError("vectors must be non-null and of one dimension")
    widths = np.diff(column.offsets.to_numpy())
    if (widths != widths[0]).any():
        raise ValueError("vectors must be of one dimension")
    return np.ascontiguousarray(values.reshape(rows, -1), dtype=np.float64)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    lengths[lengths == 0.0] = 1.0
    return matrix / lengths[:, None]


def cell_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row index, cell) pairs of an Arrow ``list<int64>`` column."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else column.combine_chunks()
    widths = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), widths), column.flatten().to_numpy()


def query_block(table: pa.Table, metric: str, celled: bool) -> QueryBlock:
    matrix = vector_matrix(table.column("query_vec"))
    if metric == "cosine":
        matrix = unit_rows(matrix)
    members = None
    if celled:
        rows, cells = cell_lists(table.column("query_cells"))
        order = np.argsort(cells, kind="stable")
        names, starts = np.unique(cells[order], return_index=True)
        members = dict(zip(names.tolist(), np.split(rows[order], starts[1:])))
    return QueryBlock(table.column("query_id").combine_chunks(), matrix, members)


class TopK:
    """Running ``k`` best rows per query over the batches of one task."""

    def __init__(self, queries: QueryBlock, k: int, metric: str):
        self.queries, self.k, self.metric = queries, k, metric
        self.floor = np.full(len(queries.ids), -np.inf)
        self.kept: pa.Table | None = None

    def add(self, ids: pa.Array, vectors: np.ndarray, cells=None) -> None:
        usable = np.isfinite(vectors).all(axis=1)
        if self.metric == "cosine":
            vectors = unit_rows(vectors)
        found = []
        if self.queries.members is None:
            every = np.arange(len(self.queries.ids))
            found += self._score(np.flatnonzero(usable), every, vectors)
        else:
            rows, names = cells
            keep = usable[rows]
            rows, names = rows[keep], names[keep]
            order = np.argsort(names, kind="stable")
            distinct, starts = np.unique(names[order], return_index=True)
            for name, members in zip(distinct.tolist(), np.split(rows[order], starts[1:])):
                if name in self.queries.members:
                    found += self._score(members, self.queries.members[name], vectors)
        if not found:
            return
        row = np.concatenate([f[0] for f in found])
        query = np.concatenate([f[1] for f in found])
        score = np.concatenate([f[2] for f in found])
        if self.queries.members is not None:  # a pair may meet in several cells
            _, first = np.unique(query.astype(np.int64) * len(ids) + row, return_index=True)
            row, query, score = row[first], query[first], score[first]
        self._merge(pa.table({"q": query, "score": score, "id": ids.take(pa.array(row))}))

    def _score(self, rows: np.ndarray, members: np.ndarray, vectors: np.ndarray):
        """Candidates that can be among the ``k`` best, with final scores."""
        if not len(rows) or not len(members):
            return
        x = vectors[rows]
        dim = max(x.shape[1], 1)
        x2 = (x * x).sum(axis=1)
        step = max(1, SCORE_CELLS // len(rows))
        for at in range(0, len(members), step):
            part = members[at : at + step]
            q = self.queries.matrix[part]
            approx = x @ q.T
            q2 = (q * q).sum(axis=1)
            reach = np.sqrt(x2.max()) + np.sqrt(q2)
            if self.metric == "l2":
                approx = 2.0 * approx - x2[:, None] - q2[None, :]
            slack = 8.0 * np.finfo(np.float64).eps * dim * reach * reach
            bound = self.floor[part]
            if len(rows) > self.k:
                cut = len(rows) - self.k
                bound = np.maximum(bound, np.partition(approx, cut, axis=0)[cut])
            r, c = np.nonzero(approx >= (bound - slack)[None, :])
            score = np.empty(len(r))
            piece = max(1, RESCORE_VALUES // dim)
            for lo in range(0, len(r), piece):
                a, b = x[r[lo : lo + piece]], q[c[lo : lo + piece]]
                score[lo : lo + piece] = (
                    -((a - b) ** 2).sum(axis=1) if self.metric == "l2" else (a * b).sum(axis=1)
                )
            yield rows[r], part[c], score

    def _merge(self, fresh: pa.Table) -> None:
        merged = fresh if self.kept is None else pa.concat_tables([self.kept, fresh])
        merged = merged.sort_by([("q", "ascending"), ("score", "descending"), ("id", "ascending")])
        q = merged.column("q").to_numpy()
        _, starts, counts = np.unique(q, return_index=True, return_counts=True)
        rank = np.arange(len(q)) - np.repeat(starts, counts)
        self.kept = merged.take(pa.array(np.flatnonzero(rank < self.k))).combine_chunks()
        last = starts + np.minimum(counts, self.k) - 1
        full = counts >= self.k
        self.floor[q[starts[full]]] = merged.column("score").to_numpy()[last[full]]

    def result(self, schema: pa.Schema) -> pa.Table:
        if self.kept is None:
            return schema.empty_table()
        score = self.kept.column("score").to_numpy()
        if self.metric == "l2":
            score = np.maximum(-score, 0.0)
        picked = self.queries.ids.take(self.kept.column("q").combine_chunks())
        return pa.table(
            [picked, self.kept.column("id"), pa.array(score)], names=["query_id", "id", "score"]
        ).cast(schema)


def _hits(corpus: DataFrame, queries: DataFrame) -> tuple[str, pa.Schema]:
    """DDL and Arrow schema of (query_id, id, score)."""
    from pyspark.sql.pandas.types import to_arrow_type

    q_type, id_type = queries.schema["query_id"].dataType, corpus.schema["id"].dataType
    ddl = f"query_id {q_type.simpleString()}, id {id_type.simpleString()}, score double"
    arrow = pa.schema(
        [("query_id", to_arrow_type(q_type)), ("id", to_arrow_type(id_type)), ("score", pa.float64())]
    )
    return ddl, arrow


def bounded_table(df: DataFrame, max_rows: int, max_bytes: int) -> pa.Table | None:
    """The rows of ``df`` when they are within both bounds, else None.

    Never fetches more than ``max_rows + 1`` rows.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return table


def query_tables(queries: DataFrame, max_rows: int, max_bytes: int) -> list[pa.Table] | None:
    """The queries as tables that are each within the bounds, or None.

    One table when all fit, else up to ``MAX_SLICES`` hashed slices. Every slice costs
    a scan of the corpus, which is less than moving the corpus through a shuffle.
    """
    whole = bounded_table(queries, max_rows, max_bytes)
    if whole is not None:
        return [whole]
    queries = staged(queries, "queries")
    slices = -(-2 * queries.count() // max_rows)
    if slices > MAX_SLICES:
        return None
    tables = []
    for i in range(slices):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(slices)) == i)
        tables.append(bounded_table(part, max_rows, max_bytes))
        if tables[-1] is None:
            return None
    return tables


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "ip",
    *,
    cells: bool = False,
    broadcast_bytes: int = 64 << 20,
    broadcast_rows: int = MAX_QUERY_ROWS,
    block_rows: int = 20_000,
) -> DataFrame:
    """``k`` nearest corpus rows of every query: (query_id, rank, id, score).

    ``corpus`` has ``id, vec`` and ``queries`` has ``query_id, query_vec``; with
    ``cells`` also ``cells array<bigint>`` and ``query_cells array<bigint>``.
    ``score`` is the inner product, the cosine, or the squared distance (``l2``,
    smaller is nearer). Rows without a vector, or with a non-finite one, have no rank.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    corpus = corpus.select("id", "vec", *(["cells"] if cells else [])).where("vec IS NOT NULL")
    queries = queries.select(
        "query_id", "query_vec", *(["query_cells"] if cells else [])
    ).where("query_vec IS NOT NULL")
    tables = query_tables(queries, broadcast_rows, broadcast_bytes)
    if tables is not None:
        hits = None
        for table in tables:
            found = _scan_against(corpus, queries, table, k, metric, cells)
            hits = found if hits is None else hits.unionByName(found)
    else:
        ddl, schema = _hits(corpus, queries)

        def pair(corpus_part: pa.Table, query_part: pa.Table) -> pa.Table:
            if not corpus_part.num_rows or not query_part.num_rows:
                return schema.empty_table()
            best = TopK(query_block(query_part, metric, False), k, metric)
            ids = pa.concat_arrays(corpus_part.column("id").chunks)
            vectors = vector_matrix(corpus_part.column("vec"))
            for at in range(0, len(ids), 10_000):
                best.add(ids.slice(at, 10_000), vectors[at : at + 10_000])
            return best.result(schema)

        hits = _block_pairs(corpus, queries, cells, block_rows, pair, ddl)
        if cells:  # a pair may meet in several cells
            hits = hits.distinct()
    return best_hits(hits, k, descending=metric != "l2")


def best_hits(hits: DataFrame, k: int, descending: bool = True) -> DataFrame:
    """Rank hits per query, best first, ties by id, and keep ``k``."""
    order: Column = F.desc("score") if descending else F.asc("score")
    window = W.partitionBy("query_id").orderBy(order, "id")
    return (
        hits.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _scan_against(corpus, queries, table, k, metric, celled) -> DataFrame:
    ddl, schema = _hits(corpus, queries)
    # A plain Arrow table: broadcast values of own classes would need the package there.
    shared = corpus.sparkSession.sparkContext.broadcast(table)

    def scan(batches):
        best = TopK(query_block(shared.value, metric, celled), k, metric)
        for batch in batches:
            if batch.num_rows and len(best.queries.ids):
                cells = cell_lists(batch.column("cells")) if celled else None
                best.add(batch.column("id"), vector_matrix(batch.column("vec")), cells)
        yield from best.result(schema).to_batches()

    return corpus.mapInArrow(scan, ddl)


def _block_pairs(corpus, queries, celled, block_rows, pair, ddl) -> DataFrame:
    """Run ``pair`` on every block of the corpus with every block of the queries.

    For query sets too large to broadcast. A row is copied once per block of the
    other side, and a block holds about ``block_rows`` rows however crowded its cell.
    """
    if celled:
        corpus = corpus.withColumn("cell", F.explode(F.array_distinct("cells"))).drop("cells")
        queries = queries.withColumn("cell", F.explode(F.array_distinct("query_cells"))).drop("query_cells")
    else:
        corpus, queries = corpus.withColumn("cell", F.lit(0)), queries.withColumn("cell", F.lit(0))

    def crowded(df: DataFrame, name: str) -> DataFrame:
        """Blocks of the cells with more than one; at most rows / block_rows entries."""
        count = df.groupBy("cell").count().where(F.col("count") > block_rows)
        return count.select("cell", F.ceil(F.col("count") / block_rows).alias(name))

    left_cells, right_cells = crowded(corpus, "lbs"), crowded(queries, "rbs")

    def cut(df: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        blocks = lambda side: F.coalesce(f"{side}s", F.lit(1).cast("bigint"))
        sized = df.join(left_cells, "cell", "left").join(right_cells, "cell", "left")
        return sized.select(
            *df.columns,
            F.pmod(F.xxhash64(id_col), blocks(own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("bigint"), blocks(other) - 1)).alias(other),
        )

    left, right = cut(corpus, "id", "lb", "rb"), cut(queries, "query_id", "rb", "lb")
    keys = ["cell", "lb", "rb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, ddl)


class Moments:
    """Running count, mean, squared deviation, least and greatest score per query."""

    names = ["query_id", "n", "m", "m2", "low", "high"]

    def __init__(self, queries: QueryBlock):
        size = len(queries.ids)
        self.queries, self.n = queries, 0
        self.mean, self.m2 = np.zeros(size), np.zeros(size)
        self.low, self.high = np.full(size, np.inf), np.full(size, -np.inf)

    def add(self, x: np.ndarray) -> None:
        x = x[np.isfinite(x).all(axis=1)]
        step = max(1, SCORE_CELLS // max(len(self.queries.ids), 1))
        for at in range(0, len(x), step):
            s = x[at : at + step] @ self.queries.matrix.T
            m, count = s.mean(axis=0), self.n + len(s)
            delta = m - self.mean
            self.m2 += ((s - m) ** 2).sum(axis=0) + delta**2 * self.n * len(s) / count
            self.mean += delta * len(s) / count
            self.low, self.high = np.minimum(self.low, s.min(axis=0)), np.maximum(self.high, s.max(axis=0))
            self.n = count

    def result(self, schema: pa.Schema) -> pa.Table:
        if not self.n:
            return schema.empty_table()
        n = pa.array(np.full(len(self.mean), self.n))
        values = [self.queries.ids, n, *map(pa.array, (self.mean, self.m2, self.low, self.high))]
        return pa.table(values, names=self.names).cast(schema)


def score_moments(
    corpus: DataFrame, queries: DataFrame, *, broadcast_bytes: int = 64 << 20, block_rows: int = 20_000
) -> DataFrame:
    """Mean, population deviation, least and greatest inner product of every query
    over the whole corpus: (query_id, n, mean, std, min, max). Vectors with a number that
    is not finite don't count, as in :func:`top_k`.

    Tasks pass on one row of moments per query, never the scores.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    corpus = corpus.select("id", "vec").where("vec IS NOT NULL")
    queries = queries.select("query_id", "query_vec").where("query_vec IS NOT NULL")
    q_type = queries.schema["query_id"].dataType
    ddl = f"query_id {q_type.simpleString()}, n bigint, m double, m2 double, low double, high double"
    schema = pa.schema(
        [("query_id", to_arrow_type(q_type)), ("n", pa.int64())]
        + [(name, pa.float64()) for name in Moments.names[2:]]
    )
    table = bounded_table(queries, MAX_QUERY_ROWS, broadcast_bytes)
    if table is not None:
        shared = corpus.sparkSession.sparkContext.broadcast(table)

        def scan(batches):
            moments = Moments(query_block(shared.value, "ip", False))
            for batch in batches:
                moments.add(vector_matrix(batch.column("vec")))
            yield from moments.result(schema).to_batches()

        parts = corpus.select("vec").mapInArrow(scan, ddl)
    else:

        def pair(corpus_part: pa.Table, query_part: pa.Table) -> pa.Table:
            if not corpus_part.num_rows or not query_part.num_rows:
                return schema.empty_table()
            moments = Moments(query_block(query_part, "ip", False))
            moments.add(vector_matrix(corpus_part.column("vec")))
            return moments.result(schema)

        parts = _block_pairs(corpus, queries, False, block_rows, pair, ddl)
    total = F.sum("n")
    centre = F.sum(F.col("n") * F.col("m")) / total
    spread = F.sum(F.col("m2") + F.col("n") * F.col("m") * F.col("m")) / total - centre * centre
    return parts.groupBy("query_id").agg(
        total.alias("n"),
        centre.alias("mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
    )


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of each query's exact hits that the approximate search found."""
    found = approximate.select("query_id", "id", F.lit(1).alias("found"))
    return (
        exact.select("query_id", "id")
        .join(found, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg((F.count("found") / F.count(F.lit(1))).alias("recall"))
    )
