"""Vectors of single tokens, from co-occurrence in the corpus.

Counts of words that stand near each other become positive pointwise mutual information;
the leading part of that sparse symmetric matrix is found by a randomised range finder.
The matrix stays distributed, as a list of neighbours for each term. The driver sees Gram
matrices of ``dim + OVERSAMPLE`` rows and columns and the rows of ``HOT`` terms, whatever the vocabulary.

Documents come as ``doc_id, text``. A null text has no tokens. Rows without ``doc_id``
have tokens and count like others.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.operators.skew import MAX_HOT_KEY_BYTES
from sahaf.operators.terms import SENT_TERMS
from sahaf.session import STAGED, drop, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words on either side that count as near; columns beyond the wanted ones; passes over the matrix that sharpen the range.
WINDOW, OVERSAMPLE, PASSES = 2, 16, 2
#: Terms whose rows are sent to all tasks, 84 MB at 80 columns; entries, and rows, that a task works on at a time.
HOT, CELLS, ROWS = 131_072, 50_000, 8_192
#: Words whose pairs a task combines at a time.
PAIR_WORDS = 1 << 20


def token_rows(docs: DataFrame, mode: str = "unicode") -> DataFrame:
    """(doc_id, sent, pos, token): the words of every sentence, in place."""
    numbered = docs.select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sent", "sentence"))
    return numbered.select("doc_id", "sent", F.posexplode(T.words(F.col("sentence"), mode)).alias("pos", "token"))


def pair_counts(docs: DataFrame, window: int = WINDOW, mode: str = "unicode") -> DataFrame:
    """(a, b, n), a <= b: how often two words stand at most ``window`` words apart in a sentence.

    Pairs are made and first combined in Arrow batches, PAIR_WORDS words at a time, and
    shuffled once; a word beside its own like counts once.
    """
    sents = docs.select(F.explode(T.sentences(F.col("text"))).alias("s"))
    lines = sents.select(T.clean(F.col("s"), mode).alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS)):
                held.append(pc.ascii_split_whitespace(part.column(0).cast(pa.large_string())))
                size += len(held[-1].values)
                if size >= PAIR_WORDS:
                    yield _combined(held, window)
                    held, size = [], 0
        if held:
            yield _combined(held, window)

    return lines.mapInArrow(run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _combined(held: list[pa.Array], window: int) -> pa.RecordBatch:
    """Rows (a, b, n) of the pairs in lists of words."""
    widths = np.concatenate([np.diff(x.offsets.to_numpy()) for x in held])
    flat = pa.concat_arrays([x.flatten() for x in held])
    solid = pc.greater(pc.binary_length(flat), 0)  # blanks at an end of a sentence leave empty words
    sent = np.repeat(np.arange(len(widths)), widths)[solid.to_numpy(zero_copy_only=False)]
    coded = flat.filter(solid).dictionary_encode()
    # Words by their place in binary order, so that the lesser place is the lesser word.
    order = pc.array_sort_indices(coded.dictionary.cast(pa.large_binary())).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    word = place[coded.indices.to_numpy()]
    full = coded.dictionary.take(pa.array(order))
    keys = []
    for by in range(1, window + 1):
        same = sent[by:] == sent[:-by]
        x, y = word[:-by][same], word[by:][same]
        keys.append(np.minimum(x, y) * len(order) + np.maximum(x, y))
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    names = [full.take(pa.array(i)).cast(pa.string()) for i in np.divmod(key, max(len(order), 1))]
    return pa.RecordBatch.from_arrays([*names, pa.array(n.astype(np.int64))], names=["a", "b", "n"])


def both_orders(pairs: DataFrame, value: str, like: Column | None = None) -> DataFrame:
    """(term, context, ``value``) from rows (a, b, ``value``): each pair in both orders, ``like`` for a word with itself."""
    mine = F.struct(F.col("a").alias("term"), F.col("b").alias("context"), value)
    other = F.struct(F.col("b").alias("term"), F.col("a").alias("context"), value)
    alone = mine if like is None else F.struct(F.col("a").alias("term"), F.col("b").alias("context"), like.alias(value))
    return pairs.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(alone)).otherwise(F.array(mine, other))))


def cooccurrence(docs: DataFrame, window: int = WINDOW, mode: str = "unicode") -> DataFrame:
    """(term, context, n): how often two words stand at most ``window`` words apart in a sentence.

    Symmetric: both orders of a pair have the same n, and a word beside its own like counts
    twice. Pairs are made inside a sentence's row and shuffled once, in one order only, after
    they were combined in the task.
    """
    return in_both_orders(pair_counts(docs, window, mode))


def in_both_orders(pairs: DataFrame) -> DataFrame:
    """(term, context, n) from :func:`pair_counts`."""
    return both_orders(pairs, "n", 2 * F.col("n"))


def ppmi(counts: DataFrame, digits: int | None = None) -> DataFrame:
    """(term, context, weight): ln(n * total / (n of the term * n of the context)), where it is over 0.

    ``counts`` is that of :func:`cooccurrence`, so symmetric: a pair is weighed, and rounded to
    ``digits``, in one order. It is read several times: pass a written table.
    """
    sums = staged(counts.groupBy("term").agg(F.sum("n").alias("term_n")), "term-sums")
    total = sums.agg(F.sum("term_n")).scalar()
    joined = with_sums(counts.where("term <= context"), sums)
    weight = F.log(F.col("n") * total.cast("double") / (F.col("term_n").cast("double") * F.col("context_n")))
    weighed = joined.select(F.col("term").alias("a"), F.col("context").alias("b"), weight.alias("weight")).where("weight > 0")
    if digits is not None:
        weighed = weighed.withColumn("weight", F.round("weight", digits))
    return both_orders(weighed, "weight")


def with_sums(pairs: DataFrame, sums: DataFrame, hot: int = SENT_TERMS) -> DataFrame:
    """(term, context, n, term_n, context_n) from pairs (term, context, n) and sums (term, term_n).

    The sums of the ``hot`` most frequent terms are sent to the pairs; only pairs with another
    term are moved to its sum. Of those, the ones that know the sum are dealt evenly.
    """
    short = F.octet_length("term") <= MAX_HOT_KEY_BYTES
    most = sums.where(short).orderBy(F.desc("term_n"), "term").limit(hot)
    met = pairs
    for side in ("term", "context"):
        met = met.join(F.broadcast(most.select(F.col("term").alias(side), F.col("term_n").alias(f"{side}_n"))), side, "left")
    columns = ["term", "context", "n", "term_n", "context_n"]
    rest = met.where("term_n IS NULL OR context_n IS NULL")
    for side in ("term", "context"):
        # No term begins with this sign.
        even = F.concat(F.lit("\0"), F.pmod(F.xxhash64("term", "context"), F.lit(1 << 16)).cast("string"))
        known = sums.select(F.col("term").alias("_key"), F.col("term_n").alias("_n"))
        rest = rest.withColumn("_key", F.when(F.col(f"{side}_n").isNull(), F.col(side)).otherwise(even)).join(known, "_key", "left")
        rest = rest.withColumn(f"{side}_n", F.coalesce(f"{side}_n", "_n")).select(*columns)
    return met.where("term_n IS NOT NULL AND context_n IS NOT NULL").select(*columns).union(rest)


def signs(term, columns: int):
    """``columns`` numbers of 1 or -1 from a term: a random row of the test matrix, the same wherever it is made."""
    words = [F.xxhash64(F.lit(i), term) for i in range(-(-columns // 64))]
    bit = lambda k: F.shiftrightunsigned(words[k // 64], k % 64).bitwiseAND(1)
    return F.array(*[(1 - 2 * bit(k)).cast("double") for k in range(columns)])


def neighbours(weights: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A symmetric matrix (term, context, weight) as one row per term, written once for all products.

    Returns (term, n), the entries of each term; (place, term, n), the ``hot`` terms with the most; and
    (term, near, far, is_hot, place). ``near`` lists the places and weights of a term's hot neighbours. ``far``
    lists its other neighbours and their weights, for terms that are not hot: what a hot term gets
    from another is in the other's ``near``. So no list is longer than ``hot``, or than the
    entries of the first term that isn't hot.
    """
    sizes = staged(weights.groupBy("term").agg(F.count("*").alias("n")), "degrees")
    short = F.octet_length("term") <= MAX_HOT_KEY_BYTES
    most = sizes.where(short).orderBy(F.desc("n"), "term").limit(hot)
    listed = most.agg(F.array_sort(F.collect_list(F.struct("term", "n"))).alias("t")).select(F.posexplode("t").alias("place", "t"))
    places = staged(listed.select("place", "t.term", "t.n"), "hot-terms")
    mine = F.broadcast(places.select("term", F.col("place").alias("own")))
    other = F.broadcast(places.select(F.col("term").alias("context"), "place"))
    met = weights.join(other, "context", "left").join(mine, "term", "left").where("place IS NOT NULL OR own IS NULL")
    lists = met.groupBy("term").agg(
        F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "weight"))).alias("near"),
        F.collect_list(F.when(F.col("place").isNull(), F.struct("context", "weight"))).alias("far"),
        F.first("own").alias("place"),
    )
    is_hot = F.when(F.col("place").isNotNull(), True).alias("is_hot")
    return sizes, places, staged(lists.select("term", "near", "far", is_hot, "place"), "neighbours")


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces that have about CELLS entries, or one row."""
    ends = np.cumsum([0, *_lengths(batch.column("near"))])
    cuts = sorted({0, len(ends) - 1, *map(int, np.searchsorted(ends, np.arange(CELLS, ends[-1], CELLS)))})
    return (batch.slice(at, stop - at) for at, stop in zip(cuts, cuts[1:]))


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def _vectors(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _matrix(vectors: pa.ListArray, columns: int) -> np.ndarray:
    """The vectors as rows; a null one is 0."""
    if not vectors.null_count:
        return vectors.flatten().to_numpy().reshape(-1, columns)
    out = np.zeros((len(vectors), columns))
    out[vectors.is_valid().to_numpy(zero_copy_only=False)] = vectors.drop_null().flatten().to_numpy().reshape(-1, columns)
    return out


def _keyed(name: str, keys: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, _vectors(values)], names=[name, "vec"])


def _near_sums(part: pa.RecordBatch, hot: np.ndarray) -> np.ndarray:
    """For each row the sum over its hot neighbours, of weight times their row of ``hot``."""
    near, sizes = part.column("near").flatten(), _lengths(part.column("near"))
    place, weight, full = near.field("place").to_numpy(), near.field("weight").to_numpy(), sizes > 0
    out = np.zeros((len(part), hot.shape[1]))
    if full.any():
        out[full] = np.add.reduceat(hot[place] * weight[:, None], (np.cumsum(sizes) - sizes)[full])
    return out


def _give(given: np.ndarray, part: pa.RecordBatch, x: np.ndarray) -> None:
    """Adds to the rows ``given`` of the hot terms what the rows ``x`` of terms that aren't hot give to them."""
    near, row = part.column("near").flatten(), np.repeat(np.arange(len(part)), _lengths(part.column("near")))
    place, weight = near.field("place").to_numpy(), near.field("weight").to_numpy()
    if len(place):
        order = np.argsort(place, kind="stable")
        to, first = np.unique(place[order], return_index=True)
        given[to] += np.add.reduceat(x[row[order]] * weight[order][:, None], first)


def _far_shares(part: pa.RecordBatch, x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row (term, vec) for each neighbour that isn't hot: the weight times the row of ``x``."""
    far, row = part.column("far").flatten(), np.repeat(np.arange(len(part)), _lengths(part.column("far")))
    for k in range(0, len(far), ROWS):
        piece = far.slice(k, ROWS)
        yield _keyed("term", piece.field("context").cast(pa.string()), x[row[k : k + ROWS]] * piece.field("weight").to_numpy()[:, None])


def _reached(given: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and values of the rows that aren't 0, ROWS at a time."""
    reached = np.flatnonzero(given.any(axis=1))
    return ((at, given[at]) for at in (reached[k : k + ROWS] for k in range(0, len(reached), ROWS)))


def _block(rows: DataFrame, size: int, columns: int) -> np.ndarray:
    """The matrix of rows (place, vec)."""
    out = np.zeros((size, columns))
    for batch in rows.select("place", "vec").toArrow().to_batches():
        out[batch.column(0).to_numpy()] = _matrix(batch.column(1), columns)
    return out


def _times(lists: DataFrame, places: DataFrame, rows: DataFrame, turn: np.ndarray) -> DataFrame:
    """(term, vec) of the matrix times rows (term, vec), each first times the small matrix ``turn``.

    For rows that are at hand as a table; :func:`fit_token_vectors` needs none.
    """
    wide, columns = turn.shape
    names = places.orderBy("place").select("term").toArrow().column("term").combine_chunks().cast(pa.string())
    shared = lists.sparkSession.sparkContext.broadcast((_block(places.join(rows, "term"), len(names), wide) @ turn, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, names = shared.value
        given = np.zeros_like(hot)
        for part in (p for batch in batches for p in _pieces(batch)):
            yield _keyed("term", part.column("term").cast(pa.string()), _near_sums(part, hot))
            rare = part.filter(part.column("is_hot").is_null())
            x = _matrix(rare.column("vec"), wide) @ turn
            _give(given, rare, x)
            yield from _far_shares(rare, x)
        for at, values in _reached(given):
            yield _keyed("term", names.take(pa.array(at)), values)

    met = lists.join(rows.select("term", "vec"), "term").select("term", "near", "far", "is_hot", "vec")
    return _summed(met.mapInArrow(run, "term string, vec array<double>"), "term", columns)


def _summed(shares: DataFrame, key: str, columns: int) -> DataFrame:
    """The sum of the vectors of each key, from rows (key, vec)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, np.zeros((1, columns))  # one sum is held between batches
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(0), run_end_type=pa.int32())
            keys, starts = runs.values, np.concatenate([[0], runs.run_ends.to_numpy()[:-1]])
            sums = np.add.reduceat(_matrix(batch.column(1), columns), starts)
            if name is not None and name.equals(keys.slice(0, 1)):
                sums[0] += held[0]
            elif name is not None:
                yield _keyed(key, name, held)
            name, held = keys.slice(len(keys) - 1), sums[-1:]
            yield _keyed(key, keys.slice(0, len(keys) - 1), sums[:-1])
        if name is not None:
            yield _keyed(key, name, held)

    return shares.repartition(key).sortWithinPartitions(key).mapInArrow(run, shares.schema)


class _Rest:
    """The terms that aren't hot during the products: their rows are made anew where they are needed.

    A row is the sum over its hot neighbours, from the rows of the hot terms in the product before, and
    one over its other neighbours. Only that second sum is kept, as ``vec`` of ``linked``, for
    the terms that have such neighbours; ``alone`` are the others. In the first product ``vec`` is the row.
    """

    def __init__(self, lists: DataFrame, columns: int):
        rest = lists.where("is_hot IS NULL").select("term", "near", "far", signs(F.col("term"), columns).alias("vec"))
        self.alone, self.linked = rest.where("size(far) = 0"), rest.where("size(far) > 0")
        self.columns, self.context = columns, lists.sparkSession.sparkContext
        self.groups = max(1, -(-lists.where("is_hot IS NULL AND size(far) > 0").count() // ROWS))
        self.before: tuple | None = None

    def shared(self):
        """Sends what the rows are made of to the tasks, and gives the function that makes them."""
        sent, columns = self.context.broadcast(self.before), self.columns

        def rows(part: pa.RecordBatch) -> np.ndarray:
            if sent.value is None:
                return _matrix(part.column("vec"), columns)
            hot, turn = sent.value
            return _near_sums(part, hot) + _matrix(part.column("vec"), columns) @ turn

        return sent, rows

    def to_hot(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """What the rows give to the ``size`` hot terms, and the Gram matrix of the rows. Each core sums in one block."""
        sent, rows = self.shared()
        columns = self.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given, gram = np.zeros((size, columns)), np.zeros((columns, columns))
            for part in (p for batch in batches for p in _pieces(batch)):
                x = rows(part)
                _give(given, part, x)
                gram += x.T @ x
            yield _keyed("place", pa.array(np.arange(size, size + columns, dtype=np.int32)), gram)
            for at, values in _reached(given):
                yield _keyed("place", pa.array(at.astype(np.int32)), values)

        every = self.alone.unionByName(self.linked).select("near", "vec").coalesce(self.context.defaultParallelism)
        table = staged(_summed(every.mapInArrow(run, "place int, vec array<double>"), "place", columns), "given")
        out = _block(table, size + columns, columns)
        drop(table.sparkSession, STAGED[-1:])
        sent.destroy()
        return out[:size], out[size:]

    def _met(self, rows, work, ddl: str) -> DataFrame:
        """``work`` on groups of about ROWS linked terms, with the shares that these get from one another."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (p for batch in batches for p in _pieces(batch)):
                yield from _far_shares(part, rows(part))

        columns, group = self.columns, F.pmod(F.xxhash64("term"), F.lit(self.groups)).alias("g")
        shares = self.linked.mapInArrow(run, "term string, vec array<double>")

        def meet(own: pa.Table, got: pa.Table) -> pa.Table:
            sums, order = np.zeros((len(own), columns)), np.zeros(0, np.int64)
            if len(got):
                at = pc.index_in(got.column("term"), value_set=own.column("term").combine_chunks()).combine_chunks()
                got, at = got.filter(at.is_valid()).combine_chunks(), at.drop_null().to_numpy()
                order = np.argsort(at, kind="stable")
            if len(order):
                to, first = np.unique(at[order], return_index=True)
                values = np.concatenate([_matrix(c, columns) for c in got.column("vec").chunks])
                sums[to] = np.add.reduceat(values[order], first)
            parts = [*_numbered(own)] or [(0, pa.RecordBatch.from_pylist([], schema=own.schema))]
            return pa.Table.from_batches([work(b, sums[a : a + len(b)]) for a, b in parts])

        pairs = self.linked.select(group, "term", "near", "far", "vec").groupBy("g").cogroup(shares.select(group, "term", "vec").groupBy("g"))
        return pairs.applyInArrow(meet, ddl)

    def move(self, before: tuple) -> None:
        """Sums what linked terms give to each other, and takes the rows of the next product from ``before``."""
        sent, rows = self.shared()

        def work(part: pa.RecordBatch, sums: np.ndarray) -> pa.RecordBatch:
            kept = [part.column(x) for x in ("term", "near", "far")]
            return pa.RecordBatch.from_arrays([*kept, _vectors(sums)], names=["term", "near", "far", "vec"])

        kinds = ", ".join(f"{x} {self.linked.schema[x].dataType.simpleString()}" for x in ("term", "near", "far", "vec"))
        old, self.linked = self.linked, staged(self._met(rows, work, kinds), "linked")
        if self.before is None:
            self.alone = self.alone.withColumn("vec", F.lit(None).cast("array<double>"))
        else:
            drop(old.sparkSession, STAGED[-2:-1])
        sent.destroy()
        self.before = before

    def image(self) -> np.ndarray:
        """The rows' transpose times what linked terms give to each other."""
        sent, rows = self.shared()
        columns = self.columns

        def work(part: pa.RecordBatch, sums: np.ndarray) -> pa.RecordBatch:
            return _keyed("place", pa.array(np.arange(columns, dtype=np.int32)), rows(part).T @ sums)

        table = staged(_summed(self._met(rows, work, "place int, vec array<double>"), "place", columns), "image")
        out = _block(table, columns, columns)
        drop(table.sparkSession, STAGED[-1:])
        sent.destroy()
        return out

    def mapped(self, matrix: np.ndarray) -> DataFrame:
        """(term, vec, n) with every row times a small matrix."""
        _, rows = self.shared()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (p for batch in batches for p in _pieces(batch)):
                n = _lengths(part.column("near")) + part.column("n_far").to_numpy()
                made = [part.column("term"), _vectors(rows(part) @ matrix), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(made, names=["term", "vec", "n"])

        every = self.alone.unionByName(self.linked).select("term", "near", "vec", F.size("far").alias("n_far"))
        return every.mapInArrow(run, "term string, vec array<double>, n long")


def _numbered(rows: pa.Table) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of rows, as by :func:`_pieces`, and the number of the first row of each."""
    at = 0
    for part in (p for batch in rows.to_batches() for p in _pieces(batch)):
        yield at, part
        at += len(part)


def _hot_product(lists: DataFrame, hot: np.ndarray) -> np.ndarray:
    """What the hot terms give to each other: the matrix of their entries times ``hot``. No row is moved but to the driver."""
    sent = lists.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in _pieces(batch)):
            yield _keyed("place", part.column("place"), _near_sums(part, sent.value))

    made = lists.where("is_hot").select("place", "near").mapInArrow(run, "place int, vec array<double>")
    out = _block(made, *hot.shape)
    sent.destroy()
    return out


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with this Gram matrix orthonormal; columns without length become 0."""
    values, axes = np.linalg.eigh(gram)
    good = values > max(values[-1], 0.0) * 1e-12
    return axes * np.where(good, 1 / np.sqrt(np.where(good, values, 1.0)), 0.0)


def fit_token_vectors(weights: DataFrame, dim: int = 64, hot: int = HOT) -> DataFrame:
    """(term, vec, n): a vector for each term of a symmetric matrix (term, context, weight), no weight below 0.

    The vectors times each other give about the matrix: they are its ``dim`` leading
    eigenvectors by size, each times the root of its eigenvalue's size. ``n`` is the number
    of entries of a term. ``weights`` is read twice: pass a written table. It is written
    once as a list of neighbours for each term, which is read in each of ``PASSES + 2`` products.

    The driver and each task hold the rows of the ``hot`` terms. Rows of other terms are neither
    moved nor written: a task makes them from the lists. Sums of what terms that aren't hot
    give to each other are moved, a row for each entry.
    """
    spark, columns = weights.sparkSession, dim + OVERSAMPLE
    _, places, lists = neighbours(weights, hot)
    size = places.count()
    rest, block, turn = _Rest(lists, columns), _block(places.select("place", signs(F.col("term"), columns).alias("vec")), size, columns), np.eye(columns)
    for product in range(PASSES + 2):
        given, gram = rest.to_hot(size)
        if product:
            turn = _orthonormal(gram + block.T @ block)
        if product <= PASSES:
            rest.move((block @ turn, turn))
            block = _hot_product(lists, block @ turn) + given @ turn
    # What the hot terms get from the others is the transpose of what these get from them.
    small = block.T @ (_hot_product(lists, block) + given) + given.T @ block + rest.image()
    small = turn.T @ small @ turn
    values, axes = np.linalg.eigh((small + small.T) / 2)
    first = np.argsort(-np.abs(values))[:dim]
    axes, values = axes[:, first], values[first]
    # An eigenvector's sign is free: the largest entry of each is made positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(first))])
    last = turn @ (axes * np.sqrt(np.abs(values)))
    sent = spark.sparkContext.broadcast(block @ last)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _vectors(sent.value[batch.column("place").to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column("term"), made, batch.column("n")], names=["term", "vec", "n"])

    return places.select("place", "term", "n").mapInArrow(named, "term string, vec array<double>, n long").union(rest.mapped(last))


def token_vectors(docs: DataFrame, vectors: DataFrame, mode: str = "unicode") -> DataFrame:
    """(doc_id, sent, pos, token, vec) of every token, from vectors (term, vec, n).

    Rows of the ``HOT`` terms with the most entries stay where they are, their vectors are sent
    to them; others meet by a shuffle. A token without vector has null.
    """
    rows = token_rows(docs, mode)
    known = vectors.select(F.col("term").alias("token"), F.col("vec").cast("array<float>").alias("vec"))
    # Names only are sorted and counted out; the vectors follow them.
    most = vectors.where(F.octet_length("term") <= MAX_HOT_KEY_BYTES).select("term", "n").orderBy(F.desc("n"), "term").limit(HOT)
    hot = F.broadcast(most.select(F.col("term").alias("token")).distinct())
    sent = F.broadcast(known.join(hot, "token", "left_semi").withColumn("_sent", F.lit(True)))
    columns = ["doc_id", "sent", "pos", "token", "vec"]
    met = rows.join(sent, "token", "left")
    others = known.join(hot, "token", "left_anti")
    return met.where("_sent").select(*columns).union(met.where("_sent IS NULL").drop("vec").join(others, "token", "left").select(*columns))
