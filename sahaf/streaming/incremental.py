"""Incremental jobs over folders that keep receiving files.

Both use a file stream with ``availableNow``: they take what is new in batches of
bounded size, then stop. Progress lives in ``checkpoint``, which has to be a shared
folder on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sahaf.functions import text as T
from sahaf.functions import vectors as V
from sahaf.sources.collection import SCHEMA, check_contract
from sahaf.sources.files import ENVELOPE, convert_envelopes, with_file


def stream_conversion(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Convert new envelope files into the Parquet table at ``target``."""
    envelopes = (
        spark.readStream.schema(ENVELOPE)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
    )
    return (
        convert_envelopes(with_file(envelopes))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_embedding(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    embed: Callable[[DataFrame], DataFrame],
    dim: int,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Embed new Markdown files and add them to the table at ``target``.

    ``embed`` adds ``vec`` to ``(id, text)``; it is brought to unit length, as by
    :func:`sahaf.sources.collection.append`. Every batch writes its own
    ``batch_id`` partition and replaces it, so a batch that is run again after a
    failure leaves no second copy. Rows that break the contract go to
    ``<target>_rejected`` with the reason.
    """
    files = (
        spark.readStream.option("pathGlobFilter", "*.md")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(source, wholetext=True)
    )
    docs = files.select(
        T.file_stem(F.col("_metadata.file_name")).alias("id"), F.col("value").alias("text")
    )

    # An empty first partition, so that earlier batches can always be read.
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.mode("ignore").parquet(f"{target}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = embed(batch).select("id", "text", "vec").persist()
        earlier = batch.sparkSession.read.parquet(target).where(F.col("batch_id") != batch_id)
        checked = check_contract(rows, dim, earlier)
        bad = checked.where("reason IS NOT NULL")
        bad.write.mode("overwrite").parquet(f"{target}_rejected/batch_id={batch_id}")
        vec = V.to_float(V.normalize(F.col("vec")))
        good = checked.where("reason IS NULL").select("id", "text", vec.alias("vec"))
        good.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        rows.unpersist()

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
