"""Document frequencies that grow with a stream, so that TF-IDF weights and the built-in embedding work in batches.

Each batch adds its own counts as one delta and commits a version with the number of
documents so far; a batch that is run again after a failure finds its number committed
and changes nothing. A model is a snapshot of one version. Deltas are merged from time to
time, as one commit, while older snapshots stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sahaf.operators.embed import embed_texts
from sahaf.operators.terms import TermModel, term_counts
from sahaf.sources import versions

#: Deltas beyond which an update merges them.
MOST_DELTAS = 64
SCHEMA = "term STRING, df LONG"


def _state(spark: SparkSession, folder: str) -> tuple[int, dict]:
    found = versions.numbers(spark, folder)
    return versions.read(spark, folder) if found else (0, {"batch": -1, "documents": 0, "deltas": []})


def _deltas(spark: SparkSession, folder: str, content: dict) -> DataFrame:
    paths = [f"{folder}/deltas/{name}" for name in content["deltas"]]
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def update_terms(docs: DataFrame, folder: str, batch_id: int, mode: str = "unicode") -> int:
    """Add a batch of documents (doc_id, text) and return the version that holds it.

    Batches have rising numbers; one that is committed already changes nothing. A document
    belongs to one batch: an id that comes again is counted again. ``versions.Conflict``
    where another writer committed meanwhile: nothing is added then.
    """
    spark = docs.sparkSession
    base, content = _state(spark, folder)
    if batch_id <= content["batch"]:
        return base
    name = uuid.uuid4().hex
    term_counts(docs, mode).groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{folder}/deltas/{name}")
    content |= {"batch": batch_id, "documents": content["documents"] + docs.count(), "deltas": [*content["deltas"], name]}
    version = versions.commit(spark, folder, base, content)
    return merge(spark, folder) if len(content["deltas"]) > MOST_DELTAS else version


def merge(spark: SparkSession, folder: str) -> int:
    """Write the sums of all deltas as one, as one commit."""
    base, content = _state(spark, folder)
    name = uuid.uuid4().hex
    _deltas(spark, folder, content).groupBy("term").agg(F.sum("df").alias("df")).write.parquet(f"{folder}/deltas/{name}")
    return versions.commit(spark, folder, base, content | {"deltas": [name]})


def terms(spark: SparkSession, folder: str, version: int | None = None) -> TermModel:
    """The frequencies and weights of a version, the last by default."""
    _, content = versions.read(spark, folder, version)
    n = F.lit(content["documents"])
    table = _deltas(spark, folder, content).groupBy("term").agg(F.sum("df").alias("df"))
    return TermModel(table.withColumn("idf", F.log((n + 1) / (F.col("df") + 1))), n)


def embed_in_batches(folder: str, dim: int) -> Callable[[DataFrame], DataFrame]:
    """For ``stream_embedding``: adds ``vec`` to (id, text) by the frequencies of ``folder`` as they are at that batch."""

    def embed(batch: DataFrame) -> DataFrame:
        docs = batch.select(F.col("id").alias("doc_id"), "text")
        vectors = embed_texts(docs, terms(batch.sparkSession, folder), dim)
        return batch.join(vectors.withColumnRenamed("doc_id", "id"), "id", "left")

    return embed
