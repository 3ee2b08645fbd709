"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STAGED: list[str] = []
#: Spark's setting that removes the shuffle files of a query when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "sahaf", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were measured with.

    Nothing in the library requires these settings; any Spark 4.1 session works.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a session in one
    process (``local[*]``) may leave it unset: a fresh local folder is made then and
    remembered. On a cluster each executor would write to a disk of its own, so there
    an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="sahaf-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(os.path.join(named, "rdd"))
    return named


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared scratch folder and return a scan of what was written.

    For results that several jobs read: computed once, and safe when an executor is
    lost. The files stay until ``release`` or ``drop`` is called: frames made from them are
    lazy, so only the caller knows when the last one has been read. ``options`` are those of
    the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    STAGED.append(path)
    # What the write shuffled is read by no other job, so it need not stay on the disks.
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.parquet(path)


def release(spark: SparkSession, since: int = 0, last: int = 0) -> int:
    """Delete the staged tables of this process; returns how many there were.

    The first ``since`` tables, in the order in which they were staged, stay, and so do the
    last ``last``. Frames that read a deleted table can't be evaluated afterwards.
    """
    used_up = STAGED[since : len(STAGED) - last]
    drop(spark, used_up)
    return len(used_up)


def drop(spark: SparkSession, names: list[str]) -> None:
    """Delete these staged tables."""
    for name in names:
        STAGED.remove(name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
