"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of documents. Rows with equal id and text are one
document in the first two stages, and rows of their own in the others. A null text or id,
very long texts, ties, an empty table and columns of any other name pass as in the operator
called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sahaf.llm import lines, mixing, packing
from sahaf.llm import ngram_join as join
from sahaf.llm import quality as perplexity
from sahaf.llm.queries import EPOCHS, SHARE, WEIGHTS, trusted_ids, vocabulary
from sahaf.llm.registry import ship
from sahaf.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within the limits of their language."""
    ship(spark)
    return perplexity.classify(docs, trusted_ids(spark, sf_dir)).where("keep").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier line is as similar to."""
    ship(spark)
    return lines.without_repeats(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row: that with the smallest id, null last.

    Rows are numbered and decided one by one, so equal rows, rows without id and different
    texts of one id are told apart. A row without words is a group of its own.
    """
    ship(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = staged(docs.select(F.monotonically_increasing_id().alias("no"), row), "join-rows")
    groups = join.similar_groups(rows.select(F.col("no").alias("doc_id"), F.col("row.text").alias("text")))
    order = F.struct(F.col("row.doc_id").isNull().alias("z"), F.col("row.doc_id").alias("id"), "no")
    named = groups.select(F.col("doc_id").alias("no"), "component_id").join(rows.select("no", order.alias("place")), "no")
    first = named.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.no").alias("no"))
    return rows.join(first, "no", "left_semi").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.mixed_texts(docs, WEIGHTS, SHARE, EPOCHS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), vocabulary(), packing.LENGTH)
