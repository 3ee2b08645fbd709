"""The queries of this subpackage and the SQL of those that SQL can state."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

from sahaf.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python tasks import it."""
    context = spark.sparkContext
    if context.applicationId not in SENT:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="sahaf-code-"), "sahaf")
        context.addPyFile(shutil.make_archive(base, "zip", root, "sahaf"))
        SENT.add(context.applicationId)


def query(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        @functools.wraps(run)
        def shipped(spark, folder):
            ship(spark)
            return run(spark, folder)

        QUERIES[name] = shipped
        if sql is not None:
            SQL[name] = sql
        return shipped

    return add
