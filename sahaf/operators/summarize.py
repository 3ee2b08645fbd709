"""Extractive summaries and control texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.functions import vectors as V
from sahaf.operators.embed import embed_documents, embed_texts
from sahaf.operators.terms import SENT_TERMS, TermModel, fit_terms, term_counts, term_positions, weigh
from sahaf.session import staged


def summarize(docs: DataFrame, sentences: int = 3, model: TermModel | None = None) -> DataFrame:
    """(doc_id, summary): the sentences with the greatest mean TF-IDF weight per word,
    in document order. Equal scores go to the earlier sentence.

    Only sentence numbers travel through the ranking; the text is cut again at the end. The
    places of the terms are written once; what moves from there are the places of terms beyond
    the SENT_TERMS most frequent, and one sum of each sentence and task.
    """
    counts = staged(term_positions(docs, move_texts=True), "positions")
    model = model or fit_terms(docs, counts).kept()
    scores = (
        weigh(counts, model, SENT_TERMS)
        .select("doc_id", F.explode("sents").alias("sent"), "weight")
        .groupBy("doc_id", "sent")
        .agg(F.round(F.avg("weight"), 10).alias("score"))
    )
    order = W.partitionBy("doc_id").orderBy(F.desc("score"), "sent")
    picks = (
        scores.withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= sentences)
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list("sent")).alias("picks"))
    )
    parts = docs.select("doc_id", T.sentences(F.col("text")).alias("s")).join(picks, "doc_id", "left")
    chosen = F.transform(F.coalesce("picks", F.array().cast("array<int>")), lambda i: F.trim(F.get("s", i)))
    return parts.select("doc_id", F.array_join(chosen, " ").alias("summary"))


def control_pairs(docs: DataFrame, slots: int = 256) -> DataFrame:
    """(doc_id, other_id): for every document one of another language.

    Documents are hashed into ``slots``. A slot keeps two representatives of different
    language, the documents with the smallest hash, so the tables broadcast here have
    at most ``slots + 1`` rows. Where a slot holds one language only, the
    representatives of the whole corpus serve. Null when the corpus has one language.
    """
    digest = F.md5(F.col("doc_id").cast("string"))
    keyed = docs.select(
        "doc_id",
        "lang",
        F.struct(digest.alias("h"), "doc_id", "lang").alias("rep"),
        F.pmod(F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint"), F.lit(slots)).alias("own"),
    )
    # Slot -1 stands for the whole corpus.
    slotted = keyed.select("lang", "rep", F.explode(F.array("own", F.lit(-1).cast("bigint"))).alias("slot"))
    # The least hash per slot and language is combined before the shuffle.
    least = slotted.groupBy("slot", "lang").agg(F.min("rep").alias("rep"))
    first = least.groupBy("slot").agg(F.min("rep").alias("first"))
    second = (
        least.join(first, "slot")
        .where(F.col("lang") != F.col("first.lang"))
        .groupBy("slot")
        .agg(F.min("rep").alias("second"))
    )
    reps = first.join(second, "slot", "left")
    local = F.broadcast(reps.where("slot >= 0").toDF("own", "a", "b"))
    whole = F.broadcast(reps.where("slot < 0").select(F.lit(True).alias("always"), F.col("first").alias("c"), F.col("second").alias("d")))

    def other(first, second):
        return F.when(F.col(f"{first}.lang") != F.col("lang"), F.col(f"{first}.doc_id")).otherwise(
            F.col(f"{second}.doc_id")
        )

    return (
        keyed.withColumn("always", F.lit(True))
        .join(local, "own", "left")
        .join(whole, "always", "left")
        .select("doc_id", F.coalesce(other("a", "b"), other("c", "d")).alias("other_id"))
    )


def pair_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(left_id, right_id, cosine) for chosen pairs of ``vectors(id, vec)``."""
    left = vectors.select(F.col("id").alias("left_id"), F.col("vec").alias("left_vec"))
    right = vectors.select(F.col("id").alias("right_id"), F.col("vec").alias("right_vec"))
    joined = pairs.join(left, "left_id").join(right, "right_id")
    return joined.select("left_id", "right_id", V.cosine(F.col("left_vec"), F.col("right_vec")).alias("cosine"))


def summary_report(docs: DataFrame, dim: int = 1024, sentences: int = 3, slots: int = 256) -> DataFrame:
    """All documents of a slot share one of two control texts, at every size of the corpus.

    (doc_id, cos_summary, cos_other): every document against its summary and
    against a document of another language.
    """
    counts = staged(term_counts(docs, move_texts=True), "counts")
    model = fit_terms(docs, counts).kept()
    own = staged(embed_documents(docs, dim, model, counts), "vectors")  # joined on both sides
    short = summarize(docs, sentences).withColumnRenamed("summary", "text")
    summaries = embed_texts(short, model, dim).withColumnRenamed("vec", "summary_vec")
    pairs = control_pairs(docs, slots)
    others = pairs.select(F.col("other_id")).distinct()  # at most 2 * (slots + 1) rows
    other_vecs = own.join(F.broadcast(others), own.doc_id == others.other_id).select(
        "other_id", F.col("vec").alias("other_vec")
    )
    return (
        own.join(summaries, "doc_id")
        .join(pairs, "doc_id")
        .join(F.broadcast(other_vecs), "other_id", "left")
        .select(
            "doc_id",
            V.cosine(F.col("vec"), F.col("summary_vec")).alias("cos_summary"),
            V.cosine(F.col("vec"), F.col("other_vec")).alias("cos_other"),
        )
    )
