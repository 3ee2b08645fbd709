"""Shared DataFrame steps of the operators: gapless numbering, runs of keys, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sahaf.session import staged

#: Words of the fixed word rule, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts(rows: int, per_part: int, least: int = 1) -> int:
    """How many parts keep each one at about ``per_part`` rows."""
    return max(least, -(-rows // per_part))


def running(df: DataFrame, group: str, key: str, value: Column, ties: list[str], ranges: int, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the group that come before.

    ``key`` is a uniform 63-bit hash, so equal widths of it are ranges of about equal
    size: rows are range-partitioned within their group, summed inside each range, and
    the ranges' totals are summed in front of each range. A group is spread over
    ``ranges`` tasks, however large it is. ``group`` and ``key`` must not be null.
    """
    width = (1 << 63) // ranges + 1
    df = df.withColumn("_range", F.floor(F.col(key) / F.lit(width)).cast("int")).withColumn("_value", value)
    totals = df.groupBy(group, "_range").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_range").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_before", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    df = df.join(starts.hint("merge"), [group, "_range"])
    return df.withColumn(name, F.col("_start") + F.col("_before")).drop("_range", "_value", "_before", "_start")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal keys from batches that are sorted by them.

    Each table holds one or more whole runs; only the last, unfinished run of a batch is
    kept for the next.
    """
    rest: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        head = tuple(batch.column(batch.schema.get_field_index(k))[0].as_py() for k in keys)
        cuts = np.flatnonzero(changed)
        if rest and head != last:
            yield pa.Table.from_batches(rest)
            rest = []
        if len(cuts):
            cut = int(cuts[-1])
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        else:
            rest.append(batch)
        last = tuple(batch.column(batch.schema.get_field_index(k))[batch.num_rows - 1].as_py() for k in keys)
    if rest:
        yield pa.Table.from_batches(rest)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of each node of the edges (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps until the edges no longer change. Each
    round is written to the shared folder; minima are combined before the shuffle, and a
    node with very many edges is split by the adaptive skew join.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    e = staged(e.distinct(), name)
    seen = None
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = staged(small.union(low.select("hi", F.col("m").alias("lo"))).distinct(), name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
