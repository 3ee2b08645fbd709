"""Mean pooling of vectors spread over rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mean_pool(df: DataFrame, keys: list[str], vec_col: str = "vec", many: bool = False) -> DataFrame:
    """Component-wise mean per key: (keys..., vec array<double>).

    The mean is combined before the shuffle, so a key that holds a large share of
    the rows costs one partial vector per task. Spark's aggregation sorts whole rows, on disk if need
    be, once a task meets over 128 keys. With ``many`` the rows of an Arrow batch are combined
    before, so that only their means are sorted: for keys whose rows lie together.
    """
    if many:
        df = _batch_means(df, keys, vec_col)
        pooled = Summarizer.mean(array_to_vector("_mean"), F.col("_n"))
    else:
        pooled = Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>")))
    return df.groupBy(*keys).agg(pooled.alias("m")).select(*keys, vector_to_array("m").alias("vec"))


def _batch_means(df: DataFrame, keys: list[str], vec_col: str) -> DataFrame:
    """(keys..., _mean, _n): the mean and number of the rows of each key in an Arrow batch.

    Rows of a batch whose vectors differ in length, or hold nulls, are left as they are.
    """
    kind = df.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(kind, FloatType | DoubleType) else F.col(vec_col).cast("array<double>")
    rows = df.select(*keys, vec.alias("_vec"))
    made = [StructField("_mean", ArrayType(DoubleType())), StructField("_n", DoubleType())]
    names = [*keys, "_mean", "_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, vectors = batch.columns[:-1], batch.columns[-1]
            values, wide = vectors.flatten(), np.diff(vectors.offsets.to_numpy())
            if vectors.null_count or values.null_count or wide[0] == 0 or (wide != wide[0]).any():
                ones = pa.array(np.ones(len(batch)))
                yield pa.RecordBatch.from_arrays([*own, vectors.cast(pa.list_(pa.float64())), ones], names=names)
                continue
            code = _codes(own, len(batch))
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            n = np.diff(first, append=len(order)).astype(np.float64)
            sums = np.add.reduceat(values.to_numpy().reshape(-1, wide[0])[order], first, dtype=np.float64)
            ends = pa.array(np.arange(0, sums.size + 1, wide[0], dtype=np.int32))
            means = pa.ListArray.from_arrays(ends, pa.array((sums / n[:, None]).ravel()))
            taken = pa.array(order[first])
            yield pa.RecordBatch.from_arrays([*(c.take(taken) for c in own), means, pa.array(n)], names=names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *made]))


def _codes(columns: list[pa.Array], size: int) -> np.ndarray:
    """A number for each row, the same only where all columns are equal."""
    code = np.zeros(size, dtype=np.int64)
    for column in columns:
        try:
            own = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy()
        except pa.ArrowNotImplementedError:  # a nested key
            own = np.arange(size)
        code = np.unique(code * size + own, return_inverse=True)[1]
    return code
