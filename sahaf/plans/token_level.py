"""Queries on single tokens: co-occurrence, its weights, token vectors and their mean."""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.operators.pooling import mean_pool
from sahaf.operators.token_vectors import WINDOW, cooccurrence, fit_token_vectors, in_both_orders, pair_counts, ppmi, token_vectors
from sahaf.plans.registry import query
from sahaf.plans.texts import SENTENCES, documents, words_sql
from sahaf.session import STAGED, release, staged

DIM = 64

NEAR = f"""near_words AS (SELECT {words_sql("s")} AS w FROM (SELECT unnest({SENTENCES.format("text")}) AS s FROM documents)),
near_pairs AS (SELECT unnest(list_concat({", ".join(
    f"list_transform(range(1, greatest(len(w) - {by - 1}, 1)), lambda i: {{'a': w[i], 'b': w[i + {by}]}})" for by in range(1, WINDOW + 1)
)})) AS p FROM near_words),
near AS (SELECT term, context, count(*) AS n FROM (SELECT p.a AS term, p.b AS context FROM near_pairs
  UNION ALL SELECT p.b, p.a FROM near_pairs) GROUP BY ALL)"""


def counted(spark, folder):
    """What ``cooccurrence`` gives, written in one order only."""
    return in_both_orders(staged(pair_counts(documents(spark, folder).select("text")), "near"))


@query("cooccurrence", f"WITH {NEAR} SELECT term, context, n FROM near")
def cooccurrences(spark, folder):
    return cooccurrence(documents(spark, folder).select("text"))


@query(
    "ppmi",
    f"""WITH {NEAR}, sums AS (SELECT term, sum(n) AS s FROM near GROUP BY term)
    SELECT near.term, context, round(ln(n * (SELECT sum(s) FROM sums)::DOUBLE / (a.s::DOUBLE * b.s)), 9) AS weight
    FROM near JOIN sums a ON a.term = near.term JOIN sums b ON b.term = context
    WHERE ln(n * (SELECT sum(s) FROM sums)::DOUBLE / (a.s::DOUBLE * b.s)) > 0""",
)
def ppmi_weights(spark, folder):
    return ppmi(counted(spark, folder), 9)


def fitted(spark, folder):
    """Vectors (term, vec, n) of all words; only they stay on the disks."""
    before = len(STAGED)
    weights = staged(ppmi(counted(spark, folder)), "ppmi")
    release(spark, since=before, last=1)
    model = staged(fit_token_vectors(weights, DIM).withColumn("vec", F.col("vec").cast("array<float>")), "token-model")
    release(spark, since=before, last=1)
    return model


@query("token_vectors")
def vectors_of_tokens(spark, folder):
    """Every token of every document with its vector; shown by its length in numbers and its norm."""
    rows = token_vectors(documents(spark, folder).select("doc_id", "text"), fitted(spark, folder))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return rows.select("doc_id", "sent", "pos", "token", F.size("vec").alias("dim"), F.round(norm, 3).alias("norm"))


@query("token_vectors_pooled")
def pooled(spark, folder):
    """Mean vector of each document's tokens."""
    rows = token_vectors(documents(spark, folder).select("doc_id", "text"), fitted(spark, folder))
    out = mean_pool(rows.where("vec IS NOT NULL"), ["doc_id"], many=True)
    return out.select("doc_id", F.size("vec").alias("dim"), F.round(F.get("vec", F.lit(0)), 4).alias("first"))
