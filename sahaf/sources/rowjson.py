"""Row-wrapped JSON: objects ``{"rows": [...]}`` for bulk load."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def pack_rows(df: DataFrame, rows_per_object: int = 1000) -> DataFrame:
    """(value): JSON objects holding up to ``rows_per_object`` neighbouring rows.

    Rows are packed where they lie, without a shuffle, so no object can outgrow the
    limit however the rows repeat.
    """
    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))

    def pack(batches):
        held: list[str] = []
        for batch in batches:
            held.extend(batch.column(0).to_pylist())
            full = [held[i : i + rows_per_object] for i in range(0, len(held), rows_per_object)]
            held = full.pop() if full else []
            if full:
                yield wrap(full)
        if held:
            yield wrap([held])

    def wrap(groups: list[list[str]]) -> pa.RecordBatch:
        objects = ['{"rows":[' + ",".join(group) + "]}" for group in groups]
        return pa.RecordBatch.from_arrays([pa.array(objects, pa.string())], names=["value"])

    return lines.mapInArrow(pack, "value string")


def unpack_rows(objects: DataFrame, schema: StructType) -> DataFrame:
    """The rows inside ``objects(value)``."""
    wrapped = StructType().add("rows", ArrayType(schema))
    return objects.select(F.from_json("value", wrapped).alias("o")).select(F.inline("o.rows"))


def write_row_json(df: DataFrame, path: str, rows_per_object: int = 1000) -> None:
    pack_rows(df, rows_per_object).write.mode("errorifexists").text(path)


def read_row_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of row-wrapped files; objects may span lines when no schema is given."""
    if schema is not None:
        return unpack_rows(spark.read.text(path), schema)
    return spark.read.option("multiLine", True).json(path).select(F.inline("rows"))
