"""Text embeddings: a built-in hashed TF-IDF projection, and a hook for models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from sahaf.functions import vectors as V
from sahaf.operators.terms import TermModel, fit_terms, term_counts, weigh, weigh_queries


def bucket(term: Column, dim: int) -> Column:
    """Component of a term: the first 8 hex digits of its MD5, modulo ``dim``."""
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def sign(term: Column) -> Column:
    """+1 or -1 by the parity of the ninth hex digit of its MD5."""
    digit = F.conv(F.substring(F.md5(term), 9, 1), 16, 10).cast("int")
    return F.when(digit % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))


def _project(docs: DataFrame, weighted: DataFrame, dim: int) -> DataFrame:
    """Unit vectors of ``docs`` from (doc_id, pos, value) contributions."""
    # One shuffle by document serves both groupings.
    weighted = weighted.select("doc_id", "pos", "value").repartition("doc_id")
    parts = weighted.groupBy("doc_id", "pos").agg(F.sum("value").alias("value"))
    entries = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("e"))
    dense = entries.select("doc_id", V.dense_from_entries(F.col("e"), dim).alias("dense"))
    vectors = dense.select("doc_id", V.to_float(V.normalize(F.col("dense"))).alias("vec"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return (
        docs.select("doc_id").join(vectors, "doc_id", "left").select("doc_id", F.coalesce("vec", zero).alias("vec"))
    )


def embed_documents(
    docs: DataFrame, dim: int = 1024, model: TermModel | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """(doc_id, vec array<float>) for the corpus, one unit vector per document.

    Every term adds its signed TF-IDF weight to one hashed component. Hashes are taken
    once per distinct term. A document without words gets the zero vector. Pass
    ``counts`` (and their ``model``) when they are already at hand.
    """
    counts = term_counts(docs) if counts is None else counts
    model = model or fit_terms(docs, counts)
    hashed = TermModel(
        model.table.withColumn("pos", bucket(F.col("term"), dim)).withColumn("sign", sign(F.col("term"))),
        model.documents,
    )
    weighted = weigh(counts, hashed).withColumn("value", F.col("sign") * F.col("weight"))
    return _project(docs, weighted, dim)


def embed_texts(texts: DataFrame, model: TermModel, dim: int = 1024) -> DataFrame:
    """Like :func:`embed_documents` for texts outside the corpus, such as queries."""
    weighted = weigh_queries(term_counts(texts), model).select(
        "doc_id",
        bucket(F.col("term"), dim).alias("pos"),
        (sign(F.col("term")) * F.col("weight")).alias("value"),
    )
    return _project(texts, weighted, dim)


def embed_with(
    df: DataFrame,
    make_model: Callable[[], Callable[[list[str]], list]],
    text_col: str = "text",
    out_col: str = "vec",
    error_col: str | None = None,
) -> DataFrame:
    """Add embeddings from a model of the caller.

    ``make_model`` runs once per task and returns a function from a list of texts to a
    list of vectors; it is called once per Arrow batch. With ``error_col`` a batch that
    fails is embedded text by text, and a text that fails has no vector but its error
    there; without it the job ends.
    """
    fields = [*df.schema.fields, StructField(out_col, ArrayType(FloatType()))]
    schema = StructType([*fields, StructField(error_col, StringType())] if error_col else fields)
    names = schema.names

    def floats(vector) -> list[float]:
        return np.asarray(vector, dtype=np.float32).tolist()

    def one_by_one(encode, texts: list[str]) -> tuple[list, list]:
        vectors, errors = [], []
        for text in texts:
            try:
                vectors.append(floats(encode([text])[0]))
                errors.append(None)
            except Exception as e:
                vectors.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        return vectors, errors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = None
        for pdf in batches:
            if encode is None:
                encode = make_model()
            texts = pdf[text_col].tolist()
            try:
                vectors, errors = [floats(v) for v in encode(texts)], [None] * len(texts)
            except Exception:
                if not error_col:
                    raise
                vectors, errors = one_by_one(encode, texts)
            pdf[out_col] = vectors
            if error_col:
                pdf[error_col] = errors
            yield pdf[names]

    return df.mapInPandas(run, schema)
