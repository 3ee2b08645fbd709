"""Vector collections: Parquet tables ``(id, text, vec)`` with a checked contract."""

from __future__ import annotations

import uuid


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from sahaf.functions import vectors as V
from sahaf.operators.skew import join_frequent_first
from sahaf.session import staged
from sahaf.sources.rowjson import read_row_json

# Limits of the collection's columns.
MAX_ID_BYTES = 100
MAX_TEXT_BYTES = 65_535
DIM = 1024

# Columns of a collection.
SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("text", StringType(), True),
        StructField("vec", ArrayType(FloatType()), False),
    ]
)


def create_collection(spark: SparkSession, name: str, more: str = "") -> None:
    """Make an empty collection unless it exists; ``more`` declares columns of the caller ("lang STRING, year INT")."""
    columns = "id STRING, text STRING, vec ARRAY<FLOAT>" + (f", {more}" if more else "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def collection_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_collections(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


def load_collection(spark: SparkSession, name: str) -> DataFrame:
    """The collection with its pages kept in memory for repeated searches."""
    spark.catalog.cacheTable(name)
    return spark.table(name)


def read_segments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One frame over the files of several segments, matched by column name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def scan(source: DataFrame, predicate: Column | str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows matching a predicate, with the wanted columns only."""
    out = source if predicate is None else source.where(predicate)
    return out.select(*columns) if columns else out


def check_contract(rows: DataFrame, dim: int = DIM, existing: DataFrame | None = None) -> DataFrame:
    """Add ``reason``: null for a good row, else the first rule it breaks.

    Rules: id present, at most 100 bytes, text at most 65,535 bytes, vector present
    and of the right dimension, id not repeated among the rows nor in ``existing``.
    Repeats are counted per id before the join back, and the ids with the most rows
    are joined without moving them. ``rows`` is read several times: stage it first
    when it is costly.
    """
    counts = rows.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    repeated = counts.where("copies > 1")
    # Rows without an id meet nothing; they stay out of the joins, where they would be one key.
    named = rows.where("id IS NOT NULL")
    marked = join_frequent_first(named, repeated, "id", "copies")
    present = F.lit(False)
    if existing is not None:
        fresh = named.select("id").distinct()
        known = existing.select("id").join(fresh, "id", "left_semi").distinct()
        marked = marked.join(known.withColumn("present", F.lit(True)), "id", "left")
        present = F.coalesce("present", F.lit(False))
    reason = (
        F.when(F.octet_length("id") > MAX_ID_BYTES, F.lit("id too long"))
        .when(F.octet_length("text") > MAX_TEXT_BYTES, F.lit("text too long"))
        .when(F.col("vec").isNull(), F.lit("vector missing"))
        .when(F.size("vec") != dim, F.lit("wrong dimension"))
        .when(F.col("copies") > 1, F.lit("id repeated"))
        .when(present, F.lit("id exists"))
    )
    nameless = rows.where("id IS NULL").select(*rows.columns, F.lit("id missing").alias("reason"))
    return marked.select(*rows.columns, reason.alias("reason")).union(nameless)


def append(rows: DataFrame, name: str, dim: int = DIM, normalize: bool = True) -> DataFrame:
    """Append good rows to a collection and return the others with their reason.

    Vectors are brought to unit length unless ``normalize`` is off. An empty frame
    appends nothing. Columns that the collection has and the rows lack become null; a
    column that the collection lacks is an error, so nothing is dropped.
    """
    spark = rows.sparkSession
    columns = spark.table(name).columns
    if unknown := [c for c in rows.columns if c not in columns]:
        raise ValueError(f"the collection has no column {', '.join(unknown)}")
    fresh = staged(rows, "append")
    checked = check_contract(fresh, dim, spark.table(name))
    # Written before the insert: afterwards the good ids would count as existing.
    rejected = staged(checked.where("reason IS NOT NULL"), "rejected")
    vec = V.to_float(V.normalize(F.col("vec"))) if normalize else V.to_float(F.col("vec"))
    own = {c: F.col(c) if c in rows.columns else F.lit(None) for c in columns} | {"vec": vec}
    good = checked.where("reason IS NULL").select(*[v.alias(c) for c, v in own.items()])
    good.write.mode("append").insertInto(name)
    return rejected


def bulk_insert(spark: SparkSession, path: str, name: str, fmt: str = "parquet", dim: int = DIM) -> DataFrame:
    """Load written files (``parquet`` or row-wrapped ``json``) into a collection."""
    rows = spark.read.parquet(path) if fmt == "parquet" else read_row_json(spark, path, SCHEMA)
    return append(rows, name, dim)


def keep_where_not(rows: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows a delete by ``predicate`` leaves; an unknown outcome deletes nothing."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return rows.where(~F.coalesce(condition, F.lit(False)))


def delete_where(spark: SparkSession, name: str, predicate: Column | str) -> None:
    """Delete rows of a collection by writing a new table and renaming it.

    The old table stays as it is until the new one is complete, and the new one has its
    partitioning. The new table has a name of its own, so no other table is touched.
    """
    fresh = f"{name}_kept_{uuid.uuid4().hex}"
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    writer = keep_where_not(spark.table(name), predicate).write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).saveAsTable(fresh)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def with_auto_id(rows: DataFrame, reproducible: bool = False) -> DataFrame:
    """Add a generated ``id``: a running number per partition, or a hash of the text."""
    made = F.xxhash64("text") if reproducible else F.monotonically_increasing_id()
    return rows.withColumn("id", made)


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, driver=driver, **options).load()


def write_jdbc(rows: DataFrame, url: str, table: str, driver: str, **options: str) -> None:
    rows.write.format("jdbc").options(url=url, dbtable=table, driver=driver, **options).mode("append").save()
