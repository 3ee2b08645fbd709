"""Vector arithmetic on ``array<float>`` / ``array<double>`` columns.

Everything here is a Column expression evaluated in the JVM, with double
accumulation whatever the element type.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def to_double(v: Column) -> Column:
    return v.cast("array<double>")


def to_float(v: Column) -> Column:
    return v.cast("array<float>")


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return _sum(F.zip_with(to_double(a), to_double(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(_sum(F.transform(to_double(v), lambda x: x * x)))


def normalize(v: Column) -> Column:
    """Scale to unit length; the zero vector is returned unchanged."""
    return let(
        norm(v),
        lambda n: F.when(n == 0.0, to_double(v)).otherwise(F.transform(to_double(v), lambda x: x / n)),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 when either side has no length."""
    return let(
        norm(a) * norm(b), lambda n: F.when(n == 0.0, F.lit(0.0)).otherwise(dot(a, b) / n)
    )


def l2_squared(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(to_double(a), to_double(b), lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(l2_squared(a, b))


def mean_pool(vectors: Column) -> Column:
    """Component-wise mean of an ``array<array<_>>``; null for an empty array.

    Suits the token vectors of one document. For vectors spread over rows use
    :func:`sahaf.operators.pooling.mean_pool`.
    """
    total = F.aggregate(
        F.slice(vectors, 2, F.greatest(F.size(vectors) - 1, F.lit(0))),
        to_double(vectors[0]),
        lambda acc, v: F.zip_with(acc, to_double(v), lambda x, y: x + y),
    )
    return F.when(F.size(vectors) > 0, F.transform(total, lambda x: x / F.size(vectors)))


def dense_from_entries(entries: Column, dim: int) -> Column:
    """Dense ``array<double>`` from ``array<struct<pos int, value double>>``.

    ``entries`` must be sorted by ``pos`` without repeats. Each entry contributes the
    zeros before it, so the cost is linear in ``dim``.
    """

    def fill(e):
        previous = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(e, i - 1)["pos"])
        zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
        filled = F.flatten(
            F.transform(
                e, lambda x, i: F.concat(zeros(x["pos"] - previous(i) - 1), F.array(x["value"]))
            )
        )
        rest = zeros(F.lit(dim) - 1 - F.get(e, F.size(e) - 1)["pos"])
        return F.when(F.size(e) == 0, zeros(F.lit(dim))).otherwise(F.concat(filled, rest))

    return let(entries, fill)


def radar_angle(index: Column, count: Column) -> Column:
    """Angle of spoke ``index`` when ``count`` spokes share a full turn."""
    return index / count * F.lit(2 * math.pi)
