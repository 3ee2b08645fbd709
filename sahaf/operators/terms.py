"""Term frequencies, TF-IDF weights and TF-IDF search.

Documents come as ``doc_id, text``. Weights follow ``tf * ln((n + 1) / (df + 1))``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.operators import nearest
from sahaf.operators.nearest import MAX_QUERY_ROWS, SCORE_CELLS, QueryBlock, TopK
from sahaf.operators.skew import join_frequent_first
from sahaf.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text of one partition where texts are shuffled by document.
PART_BYTES = 4 << 20
#: Terms sent to the tasks where counts are read from a written table; at most 256 bytes each.
SENT_TERMS = 1 << 16


def by_document(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id, text`` and other columns shuffled by document, into so many partitions that one holds about PART_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("doc_id", "text", *others).repartition(max(parts, -(-size // PART_BYTES)), "doc_id")


def term_counts(docs: DataFrame, mode: str = "unicode", move_texts: bool = False) -> DataFrame:
    """(doc_id, term, tf). ``doc_id`` is a key: rows without one are not counted.

    With ``move_texts`` the texts are shuffled instead of their counts, which take more space.
    For counts that are read once: each reading cuts the words anew.
    """
    docs = docs.where("doc_id IS NOT NULL")
    docs = by_document(docs) if move_texts else docs
    words = docs.select("doc_id", F.explode(F.split(T.clean(F.col("text"), mode), r"\s+")).alias("term")).where("term != ''")
    return words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_positions(docs: DataFrame, mode: str = "unicode", move_texts: bool = False) -> DataFrame:
    """(doc_id, term, tf, sents): the sentence number of every occurrence.

    ``move_texts`` is that of :func:`term_counts`.
    """
    docs = docs.where("doc_id IS NOT NULL")
    docs = by_document(docs) if move_texts else docs
    numbered = docs.select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sent", "sentence"))
    words = numbered.select(
        "doc_id", "sent", F.explode(T.words(F.col("sentence"), mode)).alias("term")
    )
    places = words.groupBy("doc_id", "term").agg(F.collect_list("sent").alias("sents"))
    return places.withColumn("tf", F.size("sents"))


def ngram_counts(docs: DataFrame, least: int = 2, most: int = 5, mode: str = "unicode") -> DataFrame:
    """(doc_id, n, gram, count).

    The texts are shuffled by ``doc_id`` instead of their n-grams, which take more than
    ten times the space; the counting then needs no further shuffle. A task's texts, and so
    its table of n-grams, don't grow with the corpus.
    """
    words = by_document(docs).select("doc_id", T.words(F.col("text"), mode).alias("w"))
    rows = words.select("doc_id", F.explode_outer(T.neighbours(F.col("w"), most)).alias("row"))
    grams = rows.select("doc_id", F.explode(T.ngrams(F.col("row"), least, most)).alias("g"))
    return grams.groupBy("doc_id", "g.n", "g.gram").agg(F.count(F.lit(1)).alias("count"))


@dataclass
class TermModel:
    """Document frequencies of a corpus: ``table(term, df, idf)`` and its size."""

    table: DataFrame
    documents: Column

    @property
    def unseen(self) -> Column:
        """Weight of a term that no document has."""
        return F.log(self.documents + 1)

    def kept(self) -> TermModel:
        """The model with its table written to the scratch folder, for use in several jobs."""
        return TermModel(staged(self.table, "terms"), self.documents)


def fit_terms(docs: DataFrame, counts: DataFrame | None = None) -> TermModel:
    """Inverse document frequencies. Pass ``counts`` when they are used again."""
    counts = term_counts(docs) if counts is None else counts
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    # Reading ``tf`` keeps this branch on the same shuffle as the counts themselves.
    # The filter is stated because joins would add it to some branches only.
    df = counts.where("term IS NOT NULL").groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    return TermModel(df.withColumn("idf", F.log((n + 1) / (F.col("df") + 1))), n)


def weigh(counts: DataFrame, model: TermModel, hot_keys: int = 1024) -> DataFrame:
    """Add ``weight`` to corpus counts. The ``hot_keys`` most frequent terms are joined without a shuffle."""
    joined = join_frequent_first(counts, model.table, "term", "df", hot_keys)
    return joined.withColumn("weight", F.col("tf") * F.col("idf"))


def weigh_queries(counts: DataFrame, model: TermModel) -> DataFrame:
    """Add ``weight`` to the counts of a small frame that may hold unseen terms."""
    return counts.join(model.table, "term", "left").withColumn(
        "weight", F.col("tf") * F.coalesce("idf", model.unseen)
    )


def tfidf(docs: DataFrame, mode: str = "unicode") -> DataFrame:
    """(doc_id, term, tf, weight) over the whole corpus."""
    counts = term_counts(docs, mode)
    return weigh(counts, fit_terms(docs, counts)).select("doc_id", "term", "tf", "weight")


class SparseTopK(TopK):
    """Running ``k`` best documents per query, for term lists instead of vectors."""

    def __init__(self, ids: pa.Array, rows: np.ndarray, terms: pa.Array, weights: np.ndarray, k: int):
        super().__init__(QueryBlock(ids, np.zeros((len(ids), 0)), None), k, "ip")
        self.vocabulary = pc.unique(terms)
        index = pc.index_in(terms, value_set=self.vocabulary).to_numpy()
        order = np.argsort(index, kind="stable")
        self.rows, self.weights = rows[order], weights[order]
        self.starts = np.searchsorted(index[order], np.arange(len(self.vocabulary) + 1))

    def add_terms(self, ids: pa.Array, widths: np.ndarray, terms: pa.Array, weights: np.ndarray) -> None:
        """``widths[i]`` terms belong to document ``ids[i]``, in order."""
        step = max(1, SCORE_CELLS // max(len(self.floor), 1))
        ends = np.concatenate([[0], np.cumsum(widths)])
        found = pc.index_in(terms, value_set=self.vocabulary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        index = found.fill_null(0).to_numpy()
        for at in range(0, len(ids), step):
            stop = min(at + step, len(ids))
            part = slice(ends[at], ends[stop])
            doc = np.repeat(np.arange(stop - at), widths[at:stop])[known[part]]
            term, weight = index[part][known[part]], weights[part][known[part]]
            total = np.zeros((stop - at) * len(self.floor))
            fan = self.starts[term + 1] - self.starts[term]
            cuts = np.searchsorted(np.cumsum(fan), np.arange(SCORE_CELLS, fan.sum(), SCORE_CELLS))
            for piece in np.split(np.arange(len(term)), cuts):
                width = fan[piece]
                offset = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                at_query = np.repeat(self.starts[term[piece]], width) + offset
                cell = np.repeat(doc[piece], width) * len(self.floor) + self.rows[at_query]
                value = np.repeat(weight[piece], width) * self.weights[at_query]
                total += np.bincount(cell, weights=value, minlength=len(total))
            self._keep(ids.slice(at, stop - at), total.reshape(stop - at, len(self.floor)))

    def _keep(self, ids: pa.Array, scores: np.ndarray) -> None:
        scores = np.round(scores, 10)
        bound = np.maximum(self.floor, np.nextafter(0.0, 1.0))
        if len(scores) > self.k:
            cut = len(scores) - self.k
            bound = np.maximum(bound, np.partition(scores, cut, axis=0)[cut])
        row, query = np.nonzero(scores >= bound[None, :])
        if len(row):
            self._merge(
                pa.table({"q": query, "score": scores[row, query], "id": ids.take(pa.array(row))})
            )


def _query_terms(table: pa.Table, k: int) -> SparseTopK:
    """Kernel for a table of (query_id, entries)."""
    column = pa.chunked_array(table.column("entries")).combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    widths = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    ids = pa.concat_arrays(table.column("query_id").chunks)
    return SparseTopK(
        ids, np.repeat(np.arange(len(ids)), widths), flat.field("term"), flat.field("weight").to_numpy(), k
    )


def sparse_top_k(
    docs: DataFrame, queries: DataFrame, k: int, *, broadcast_bytes: int = 64 << 20, block_rows: int = 20_000
) -> DataFrame:
    """``k`` documents with the largest sum of products per query, zero excluded:
    (query_id, rank, id, score), scores rounded to 10 places.

    ``docs`` has ``id`` and ``queries`` has ``query_id``, both with
    ``entries array<struct<term string, weight double>>``. Plans and bounds are those
    of :func:`sahaf.operators.nearest.top_k`.
    """
    ddl, schema = nearest._hits(docs, queries)
    table = nearest.bounded_table(queries.select("query_id", "entries"), MAX_QUERY_ROWS, broadcast_bytes)
    corpus = docs.select("id", "entries").where(F.size("entries") > 0)

    def feed(best: SparseTopK, ids, entries) -> None:
        flat = entries.flatten()
        widths = np.diff(entries.offsets.to_numpy())
        best.add_terms(ids, widths, flat.field("term"), flat.field("weight").to_numpy())

    if table is not None:
        if not table.num_rows:
            hits = corpus.sparkSession.createDataFrame([], ddl)
        else:
            shared = corpus.sparkSession.sparkContext.broadcast(table)

            def scan(batches):
                best = _query_terms(shared.value, k)
                for batch in batches:
                    if batch.num_rows:
                        feed(best, batch.column("id"), batch.column("entries"))
                yield from best.result(schema).to_batches()

            hits = corpus.mapInArrow(scan, ddl)
    else:

        def pair(corpus_part: pa.Table, query_part: pa.Table) -> pa.Table:
            if not corpus_part.num_rows or not query_part.num_rows:
                return schema.empty_table()
            best = _query_terms(query_part, k)
            for batch in corpus_part.to_batches():
                feed(best, batch.column("id"), batch.column("entries"))
            return best.result(schema)

        hits = nearest._block_pairs(corpus, queries, False, block_rows, pair, ddl)
    return nearest.best_hits(hits, k)


def _entries(weighted: DataFrame, id_col: str | list[str], keep: Column) -> DataFrame:
    """One row per document: unit-length weights of the terms to ``keep``."""
    keys = [id_col] if isinstance(id_col, str) else id_col
    entry = F.when(keep, F.struct("term", "weight"))
    lists = weighted.groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"),
        F.array_sort(F.collect_list(entry)).alias("raw"),
    )
    scaled = F.transform(
        "raw", lambda e: F.struct(e["term"].alias("term"), (e["weight"] / F.col("length")).alias("weight"))
    )
    return lists.where("length > 0").select(*keys, scaled.alias("entries"))


def tfidf_search(
    docs: DataFrame, queries: DataFrame, k: int = 10, mode: str = "unicode", **options
) -> DataFrame:
    """Cosine of TF-IDF vectors: the ``k`` best documents of every query text.

    ``queries`` has ``query_id, text``. Weights are fitted on ``docs``. A document
    without a word of the query scores zero and is not returned.
    """
    # The query weights are needed before the corpus is scored; staging the counts keeps
    # the corpus from being tokenised for each of the two jobs.
    counts = staged(term_counts(docs, mode, move_texts=True), "counts")
    model = fit_terms(docs, counts).kept()
    asked = term_counts(queries.select(F.col("query_id").alias("doc_id"), "text"), mode)
    wanted = asked.select("term").distinct().withColumn("asked", F.lit(True))
    marked = TermModel(model.table.join(wanted, "term", "left"), model.documents)
    doc_entries = _entries(weigh(counts, marked), "doc_id", F.col("asked"))
    query_entries = _entries(weigh_queries(asked, model), "doc_id", F.lit(True))
    return sparse_top_k(
        doc_entries.withColumnRenamed("doc_id", "id"),
        query_entries.withColumnRenamed("doc_id", "query_id"),
        k,
        **options,
    )


def hashed_tfidf(tokens_col: str = "tokens", features: int = 10_000) -> Pipeline:
    """Spark ML stages: hashed counts, IDF, assembled into ``vector``."""
    return Pipeline(
        stages=[
            HashingTF(inputCol=tokens_col, outputCol="raw_features", numFeatures=features),
            IDF(inputCol="raw_features", outputCol="features"),
            VectorAssembler(inputCols=["features"], outputCol="vector"),
        ]
    )


def fit_hashed_tfidf(docs: DataFrame, features: int = 10_000, mode: str = "ascii") -> tuple[PipelineModel, DataFrame]:
    """Fitted stages and the documents with ``tokens`` and ``vector``."""
    prepared = docs.withColumn("tokens", T.words(F.col("text"), mode))
    model = hashed_tfidf(features=features).fit(prepared)
    return model, model.transform(prepared)
