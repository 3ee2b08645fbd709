"""Collections with versions: appends and deletes that rewrite no data file.

A version names folders of data files, of keys and of deleted places. A delete writes the
places (file, row) of the rows concerned; a read leaves them out. An append checks its ids
against the keys only in the buckets that its own ids fall into, and only in appends whose
range of ids reaches into its own. Each change is one commit, so a reader always sees a
whole version, and two appends of one id can't both succeed: the second is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sahaf.functions import vectors as V
from sahaf.session import staged
from sahaf.sources import versions
from sahaf.sources.collection import DIM, check_contract

#: Buckets of ids, by hash.
BUCKETS = 256


def create(spark: SparkSession, folder: str, more: str = "") -> int:
    """Make an empty collection of (id, text, vec, ..); ``more`` declares columns of the caller."""
    schema = "id STRING, text STRING, vec ARRAY<FLOAT>" + (f", {more}" if more else "")
    return versions.commit(spark, folder, 0, {"schema": schema, "data": [], "keys": [], "deletes": []})


def _bucket(key: str = "id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _placed(spark: SparkSession, folder: str, content: dict) -> DataFrame:
    """All rows that are not deleted, with ``_file`` and ``_row``: the place of each."""
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if not content["data"]:
        return spark.createDataFrame([], f"{content['schema']}, _file STRING, _row LONG")
    paths = [f"{folder}/data/{name}" for name in content["data"]]
    rows = spark.read.schema(content["schema"]).parquet(*paths).select("*", *place)
    if not content["deletes"]:
        return rows
    gone = spark.read.schema("_file STRING, _row LONG").parquet(*[f"{folder}/deletes/{name}" for name in content["deletes"]])
    return rows.join(gone, ["_file", "_row"], "left_anti")


def scan(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the last by default."""
    _, content = versions.read(spark, folder, version)
    return _placed(spark, folder, content).drop("_file", "_row")


def _known(spark: SparkSession, folder: str, content: dict, fresh: DataFrame) -> DataFrame | None:
    """The ids that the collection may share with the new rows: keys of their buckets, from appends that reach into their range."""
    asked = fresh.where("id IS NOT NULL").agg(F.min("id"), F.max("id"), F.collect_set(_bucket())).first()
    reach = [k for k in content["keys"] if asked[0] is not None and k["least"] <= asked[1] and k["most"] >= asked[0]]
    if not reach:
        return None
    keys = spark.read.schema("id STRING, bucket INT").option("basePath", f"{folder}/keys").parquet(*[f"{folder}/keys/{k['name']}" for k in reach])
    # At most BUCKETS numbers, as a literal filter on the partition column.
    return keys.where(F.col("bucket").isin(asked[2])).select("id")


def append(rows: DataFrame, folder: str, dim: int = DIM, normalize: bool = True) -> DataFrame:
    """Append good rows as one commit and return the others with their reason, as for plain collections.

    ``versions.Conflict`` where another writer committed meanwhile: nothing is appended then.
    An id that was deleted may be appended again.
    """
    spark = rows.sparkSession
    base, content = versions.read(spark, folder)
    columns = spark.createDataFrame([], content["schema"]).columns
    if unknown := [c for c in rows.columns if c not in columns]:
        raise ValueError(f"the collection has no column {', '.join(unknown)}")
    fresh = staged(rows, "append")
    checked = staged(check_contract(fresh, dim, _known(spark, folder, content, fresh)), "checked")
    vec = V.to_float(V.normalize(F.col("vec"))) if normalize else V.to_float(F.col("vec"))
    own = {c: F.col(c) if c in rows.columns else F.lit(None) for c in columns} | {"vec": vec}
    good = checked.where("reason IS NULL")
    range_of = good.agg(F.min("id"), F.max("id")).first()
    if range_of[0] is not None:
        name = uuid.uuid4().hex
        good.select(*[v.alias(c) for c, v in own.items()]).write.parquet(f"{folder}/data/{name}")
        keyed = good.select("id", _bucket().alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "id")
        keyed.write.partitionBy("bucket").parquet(f"{folder}/keys/{name}")
        keys = [*content["keys"], {"name": name, "least": range_of[0], "most": range_of[1]}]
        versions.commit(spark, folder, base, content | {"data": [*content["data"], name], "keys": keys})
    return checked.where("reason IS NOT NULL")


def delete_where(spark: SparkSession, folder: str, predicate: Column | str) -> int:
    """Delete the rows that the predicate holds for, as one commit; returns how many. No data file is written.

    The keys of deleted rows go with them, bucket by bucket.
    """
    base, content = versions.read(spark, folder)
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    gone = staged(_placed(spark, folder, content).where(condition).select("_file", "_row", "id"), "deleted")
    count = gone.count()
    if count:
        name = uuid.uuid4().hex
        gone.select("_file", "_row").write.parquet(f"{folder}/deletes/{name}")
        keys = _without(spark, folder, content["keys"], gone)
        versions.commit(spark, folder, base, content | {"deletes": [*content["deletes"], name], "keys": keys})
    return count


def _without(spark: SparkSession, folder: str, keys: list[dict], gone: DataFrame) -> list[dict]:
    """Keys without those of deleted rows: appends whose range holds one of them get their keys written anew."""
    low, high = gone.agg(F.min("id"), F.max("id")).first()
    out = []
    for k in keys:
        if k["least"] > high or k["most"] < low:
            out.append(k)
            continue
        own = spark.read.schema("id STRING, bucket INT").parquet(f"{folder}/keys/{k['name']}")
        name = uuid.uuid4().hex
        kept = staged(own.join(gone.select("id"), "id", "left_anti"), "keys")
        least, most = kept.agg(F.min("id"), F.max("id")).first()
        if least is not None:
            kept.repartition("bucket").sortWithinPartitions("bucket", "id").write.partitionBy("bucket").parquet(f"{folder}/keys/{name}")
            out.append({"name": name, "least": least, "most": most})
    return out


def compact(spark: SparkSession, folder: str) -> int:
    """Write all rows and keys anew, without deleted ones, as one commit; earlier versions can still be read."""
    base, content = versions.read(spark, folder)
    name = uuid.uuid4().hex
    rows = _placed(spark, folder, content).drop("_file", "_row")
    rows.write.parquet(f"{folder}/data/{name}")
    written = spark.read.schema(content["schema"]).parquet(f"{folder}/data/{name}")
    least, most = written.agg(F.min("id"), F.max("id")).first()
    fresh = {"data": [], "keys": [], "deletes": []}
    if least is not None:
        keyed = written.select("id", _bucket().alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "id")
        keyed.write.partitionBy("bucket").parquet(f"{folder}/keys/{name}")
        fresh = {"data": [name], "keys": [{"name": name, "least": least, "most": most}], "deletes": []}
    return versions.commit(spark, folder, base, content | fresh)


def vacuum(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions and delete the folders that none of these names; no writer may be at work."""
    found = versions.numbers(spark, folder)
    held = [versions.read(spark, folder, n)[1] for n in found[-keep:]]
    for n in found[:-keep]:
        versions.remove(spark, f"{folder}/versions/{n:012d}.json")
    removed = []
    for kind in ("data", "deletes", "keys"):
        named = {x["name"] if isinstance(x, dict) else x for content in held for x in content[kind]}
        for name in versions.children(spark, f"{folder}/{kind}"):
            if name not in named:
                versions.remove(spark, f"{folder}/{kind}/{name}")
                removed.append(f"{kind}/{name}")
    return removed
