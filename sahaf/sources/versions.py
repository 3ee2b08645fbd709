"""Numbered versions of a folder: each a small JSON file, committed by a rename that fails where the number is taken.

A writer reads version n, prepares files that nothing points to yet, and commits version
n + 1. Of two writers that began at n one succeeds and the other gets ``Conflict``; its
files stay unread. A reader of a version is not touched by later ones. The rename is atomic
where the store's own is, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed since the version that this one began at."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all committed versions, rising."""
    path = _path(spark, f"{folder}/versions")
    system = _system(spark, path)
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def read(spark: SparkSession, folder: str, number: int | None = None) -> tuple[int, dict]:
    """A version, the last by default, and its content; ``FileNotFoundError`` where there is none."""
    found = numbers(spark, folder)
    if not found or number is not None and number not in found:
        raise FileNotFoundError(f"no version {'' if number is None else number} in {folder}")
    number = found[-1] if number is None else number
    rows = spark.read.text(f"{folder}/versions/{number:012d}.json", wholetext=True).collect()
    return number, json.loads(rows[0][0])


def commit(spark: SparkSession, folder: str, base: int, content: dict) -> int:
    """Make ``content`` version ``base + 1``; ``Conflict`` where that number is taken."""
    number = base + 1
    made = _path(spark, f"{folder}/versions/_{uuid.uuid4().hex}")
    final = _path(spark, f"{folder}/versions/{number:012d}.json")
    system = _system(spark, made)
    out = system.create(made, True)
    out.write(json.dumps(content).encode())
    out.close()
    kinds = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = next(k for k in kinds.getEnumConstants() if k.name() == "NONE")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration()) if made.toUri().getScheme() else spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    try:
        context.rename(made, final, none)
    except Py4JJavaError as error:
        system.delete(made, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise Conflict(f"version {number} of {folder} was committed by another writer") from None
        raise
    return number


def remove(spark: SparkSession, name: str) -> None:
    path = _path(spark, name)
    _system(spark, path).delete(path, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    path = _path(spark, folder)
    system = _system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []
