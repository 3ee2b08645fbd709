"""Reading documents and embeddings from files, and converting envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sahaf.functions import text as T
from sahaf.functions.html import html_to_markdown

METADATA_FIELDS = ["FMTY", "FMC", "FMTE", "FMU", "PTID", "TID", "SID"]
ENVELOPE = StructType(
    [
        StructField("data", StringType()),
        StructField("metadata", StructType([StructField(f, StringType()) for f in METADATA_FIELDS])),
        StructField("_corrupt_record", StringType()),
    ]
)


def with_file(df: DataFrame) -> DataFrame:
    """Add ``doc_id`` (file stem) and ``file`` (path)."""
    name = F.col("_metadata.file_name")
    return df.select(T.file_stem(name).alias("doc_id"), F.col("_metadata.file_path").alias("file"), "*")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """JSON envelopes, one object per file: (doc_id, file, data, metadata, _corrupt_record)."""
    return with_file(
        spark.read.schema(ENVELOPE).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    )


def convert_envelopes(envelopes: DataFrame) -> DataFrame:
    """(doc_id, file, markdown, error): exactly one of the last two is set per row.

    A page that cannot be converted is reported and never stops the job.
    """
    broken = F.col("_corrupt_record") if "_corrupt_record" in envelopes.columns else F.lit(None)
    error = (
        F.when(broken.isNotNull(), F.lit("not a JSON envelope"))
        .when(F.col("data").isNull(), F.lit("no data"))
        .when(F.trim("data") == "", F.lit("empty data"))
    )
    rows = html_to_markdown(envelopes.select("doc_id", "file", "data", error.alias("error")), "data")
    return rows.select(
        "doc_id", "file", F.when(F.col("error").isNull(), F.col("markdown")).alias("markdown"), "error"
    )


def write_markdown_files(converted: DataFrame, path: str) -> None:
    """One folder per document, ``doc_id=<id>/part-*.txt``, for the rows without error.

    Meant for exports; at scale keep the Parquet table.
    """
    (
        converted.where("error IS NULL")
        .select("doc_id", F.col("markdown").alias("value"))
        .write.partitionBy("doc_id")
        .option("lineSep", "\n")
        .mode("append")
        .text(path)
    )


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Whole Markdown files: (doc_id, text). Spark skips files of zero bytes."""
    files = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return with_file(files).select("doc_id", F.col("value").alias("text"))


def spread(files: DataFrame) -> DataFrame:
    """Rows of a file scan over all cores when the scan has fewer splits than cores.

    A Parquet file with one row group is one split, and text work on it would run in
    one task. A table with enough splits is returned as it is.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(cores) if files.rdd.getNumPartitions() < cores else files


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Paths with a suffix, in order: (doc_id, file)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    return files.select(T.file_stem(F.col("path")).alias("doc_id"), F.col("path").alias("file")).orderBy("file")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_embedding_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects from document id to vector: (doc_id, vec array<float>)."""
    whole = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", "map<string,array<double>>").alias("m"))
    return parsed.select(F.explode("m").alias("doc_id", "vec")).select(
        "doc_id", F.col("vec").cast("array<float>").alias("vec")
    )


def with_embeddings(docs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Documents that have an embedding, with it."""
    return docs.join(embeddings.where("vec IS NOT NULL"), "doc_id")


def without_embeddings(docs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Documents whose embedding is missing."""
    return docs.join(embeddings.where("vec IS NOT NULL").select("doc_id"), "doc_id", "left_anti")
