"""A corpus pipeline of five stages; each stage's rows are written and read by the next."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sahaf.llm.stages import line_dedup, mix, ngram_join, pack, quality  # noqa: E402
from sahaf.session import STAGED, release, staged  # noqa: E402

STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL can't state a trained language model, hash orders or packing. Tests hold each stage's operator against brute
#: force, and the stages against a plain version on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir`` to packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = len(STAGED)
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, since=before, last=1)
    return STAGES[-1][1](spark, docs, sf_dir)
