"""Unsupervised keywords per document from local term statistics.

Features and scores follow the published single-document method (Campos et al.,
Information Sciences 509, 2020), on stems. A lower score is a better keyword.

Every step groups by ``doc_id`` and more, so the one shuffle of the documents by
``doc_id`` at the start serves the whole chain. No group outgrows one document.
"""

from __future__ import annotations

from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.operators.terms import by_document


def keyword_tokens(docs: DataFrame) -> DataFrame:
    """One row per word: (doc_id, n_sents, sent, chunk, pos, word, before, after, stem, stop).

    A chunk is a run of words without punctuation inside one sentence. ``before`` and
    ``after`` are the neighbouring words in the chunk, null at its ends.
    """
    # The partitions follow the text, so the tokens that a task sorts don't grow with the corpus.
    split = by_document(docs, "lang").select("doc_id", "lang", T.sentences(F.col("text")).alias("s"))
    sents = split.select(
        "doc_id", "lang", F.size("s").alias("n_sents"), F.posexplode_outer("s").alias("sent", "sentence")
    )  # outer: an inner explode would make Spark cut the sentences twice to test for none
    chunks = sents.select(
        "doc_id", "lang", "n_sents", "sent", F.posexplode(T.word_chunks(F.col("sentence"))).alias("chunk", "words")
    )
    # Neighbours are zipped in before the explode, so a row never carries its whole chunk.
    nothing = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        F.col("words").alias("surface"),
        F.concat(nothing, "words").alias("before"),
        F.concat(F.slice("words", 2, F.size("words")), nothing).alias("after"),
    )
    words = chunks.select(
        "doc_id", "lang", "n_sents", "sent", "chunk", F.posexplode(zipped).alias("pos", "w")
    ).where("w.surface IS NOT NULL")
    folded = words.select(
        "doc_id", "lang", "n_sents", "sent", "chunk", "pos",
        F.col("w.surface").alias("surface"),
        *[
            T.fold(F.col(f"w.{name}"), F.col("lang")).alias(to)
            for name, to in [("surface", "word"), ("before", "before"), ("after", "after")]
        ],
    )
    return folded.select(
        "*",
        T.stem(F.col("word"), F.col("lang")).alias("stem"),
        T.is_stop_word(F.col("word"), F.col("lang")).alias("stop"),
    )


def term_statistics(tokens: DataFrame) -> DataFrame:
    """Counts per (doc_id, stem), with the places the stem occurs at."""
    surface = F.col("surface")
    acronym = surface.rlike(r"^\p{Lu}{2,}$")
    capital = surface.rlike(r"^\p{Lu}") & ~acronym
    start = (F.col("chunk") == 0) & (F.col("pos") == 0)
    grouped = tokens.groupBy("doc_id", "stem").agg(
        F.count_if(capital & ~start).alias("tf_capital"),
        F.count_if(acronym).alias("tf_acronym"),
        F.bool_and("stop").alias("stop"),
        F.max("n_sents").alias("n_sents"),
        F.collect_list(F.struct("sent", "chunk", "pos", "before", "after")).alias("places"),
    )
    listed = grouped.select(
        "*",
        F.size("places").alias("tf"),
        F.array_sort("places.sent").alias("at"),
        F.array_compact("places.before").alias("left"),
        F.array_compact("places.after").alias("right"),
    )
    middle = lambda i: F.get("at", F.floor(i).cast("int"))
    return listed.select(
        "doc_id", "stem", "tf", "tf_capital", "tf_acronym", "stop", "n_sents", "places",
        ((middle((F.col("tf") - 1) / 2) + middle(F.col("tf") / 2)) / 2).alias("median_sent"),
        F.size(F.array_distinct("at")).alias("sents"),
        F.size("left").alias("n_before"),
        F.size("right").alias("n_after"),
        F.size(F.array_distinct("left")).alias("d_before"),
        F.size(F.array_distinct("right")).alias("d_after"),
    )


def term_scores(stats: DataFrame) -> DataFrame:
    """Score ``s`` per (doc_id, stem); lower is more telling."""
    doc = W.partitionBy("doc_id")
    content = F.when(~F.col("stop"), F.col("tf"))
    with_doc = stats.select(
        "*",
        F.avg(content).over(doc).alias("mean_tf"),
        F.stddev_pop(content).over(doc).alias("std_tf"),
        F.max("tf").over(doc).alias("max_tf"),
    )
    share = lambda distinct, total: F.when(F.col(total) > 0, F.col(distinct) / F.col(total)).otherwise(0.0)
    features = with_doc.select(
        "doc_id", "stem", "stop", "places",
        (F.greatest("tf_capital", "tf_acronym") / (1 + F.log("tf"))).alias("case"),
        F.log(F.log(3 + F.col("median_sent"))).alias("position"),
        (F.col("tf") / F.coalesce(F.col("mean_tf") + F.col("std_tf"), F.lit(1.0))).alias("norm"),
        (
            1 + (share("d_before", "n_before") + share("d_after", "n_after")) * F.col("tf") / F.col("max_tf")
        ).alias("rel"),
        (F.col("sents") / F.col("n_sents")).alias("spread"),
    )
    weight = F.col("case") + F.col("norm") / F.col("rel") + F.col("spread") / F.col("rel")
    return features.select(
        "doc_id", "stem", "stop", "places", (F.col("rel") * F.col("position") / weight).alias("s")
    )


def extract_keywords(
    docs: DataFrame,
    min_n: int = 2,
    max_n: int = 5,
    threshold: float = 0.6,
    n_keywords: int = 20,
) -> DataFrame:
    """(doc_id, rank, keyword, score) of ``docs(doc_id, lang, text)``.

    Candidates are runs of ``min_n`` to ``max_n`` stems in one chunk that neither begin
    nor end with a stop word. Scores up to ``threshold`` count; the ``n_keywords``
    lowest are kept per document. Scores equal to 9 digits are ordered by keyword.
    """
    scored = term_scores(term_statistics(keyword_tokens(docs)))
    placed = scored.select("doc_id", "stem", "stop", "s", F.explode("places").alias("p"))
    in_chunk = W.partitionBy("doc_id", "sent", "chunk").orderBy("pos")
    token = F.struct("stem", "stop", "s")
    ahead = placed.select("doc_id", "p.sent", "p.chunk", "p.pos", token.alias("t0")).select(
        "doc_id", "t0", *[F.lead("t0", i).over(in_chunk).alias(f"t{i}") for i in range(1, max_n)]
    )

    def run(n: int) -> Column:
        part = lambda name: [F.col(f"t{i}.{name}") for i in range(n)]
        inside = ~F.col("t0.stop") & ~F.col(f"t{n - 1}.stop")
        return F.when(
            inside,
            F.struct(
                F.concat_ws(" ", *part("stem")).alias("keyword"),
                reduce(mul, part("s")).alias("product"),
                reduce(add, part("s")).alias("total"),
            ),
        )

    runs = F.array(*[run(n) for n in range(min_n, max_n + 1)])
    grams = ahead.where("NOT t0.stop").select("doc_id", F.explode(runs).alias("g"))
    grams = grams.where("g IS NOT NULL").select("doc_id", "g.*")
    candidates = grams.groupBy("doc_id", "keyword").agg(
        (F.max("product") / (F.count(F.lit(1)) * (1 + F.max("total")))).alias("score")
    )
    best = W.partitionBy("doc_id").orderBy(F.round(F.log("score"), 9), "keyword")
    return (
        candidates.where(F.col("score") <= threshold)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n_keywords)
        .select("doc_id", "rank", "keyword", "score")
    )


def as_annotations(keywords: DataFrame) -> DataFrame:
    """(doc_id, keywords array<struct<keyword, score>>), best first."""
    return keywords.groupBy("doc_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "keyword", "score"))),
            lambda k: F.struct(k["keyword"].alias("keyword"), k["score"].alias("score")),
        ).alias("keywords")
    )


def corpus_keywords(keywords: DataFrame) -> DataFrame:
    """The least score of each keyword over all documents, ascending, from rows of :func:`extract_keywords`."""
    return keywords.groupBy("keyword").agg(F.min("score").alias("score")).orderBy("score", "keyword")
