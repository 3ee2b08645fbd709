"""One entry point for the search methods, and the rendering of hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.functions.citations import law_references
from sahaf.operators.ivf import ivf_search
from sahaf.operators.lsh import fit_lsh, lsh_search
from sahaf.operators.nearest import top_k
from sahaf.session import staged

#: Hits that are sent to every task, a few dozen bytes each.
MAX_SENT_HITS = 100_000


def search(
    queries: DataFrame, corpus: DataFrame, metric: str = "ip", k: int = 10, method: str = "exact", **options
) -> DataFrame:
    """Nearest rows of ``corpus(id, vec)`` for ``queries(query_id, query_vec)``.

    ``method`` is ``exact``; ``ivf`` with ``centroids`` and ``nprobe``, over a corpus that
    has ``cell``; or ``lsh`` with an optional fitted ``model``, always Euclidean.
    """
    if method == "exact":
        return top_k(corpus, queries, k, metric, **options)
    if method == "ivf":
        return ivf_search(corpus, queries, options.pop("centroids"), k, metric=metric, **options)
    if method == "lsh":
        model = options.pop("model", None) or fit_lsh(corpus)
        return lsh_search(model, corpus, queries, k, **options)
    raise ValueError("method must be exact, ivf or lsh")


def with_texts(hits: DataFrame, docs: DataFrame, key: str = "id") -> DataFrame:
    """Hits with the columns of their documents.

    Hits are written and counted first. Few enough are sent to the tasks that read the
    documents, so the texts of the corpus stay where they are; more are joined by a shuffle.
    """
    hits = staged(hits, "hits")
    return docs.join(F.broadcast(hits), key) if hits.count() <= MAX_SENT_HITS else hits.join(docs, key)


def render_hits(hits: DataFrame, docs: DataFrame, length: int = 500, decimals: int = 3) -> DataFrame:
    """Hits with their text (joined after the ranking) as columns to print:
    (query_id, rank, id, score, preview). ``docs`` has ``id, text``.
    """
    return with_texts(hits, docs.select("id", "text")).select(
        "query_id",
        "rank",
        "id",
        T.fixed(F.col("score"), decimals).alias("score"),
        T.preview(F.col("text"), length).alias("preview"),
    )


def extract_law_refs(docs: DataFrame) -> DataFrame:
    """(doc_id, number, law, article), one row per reference."""
    return docs.select("doc_id", F.explode(law_references(F.col("text"))).alias("r")).select("doc_id", "r.*")
