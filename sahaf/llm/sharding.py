"""Shards of equal bytes by Karmarkar-Karp differencing over indivisible groups.

A partial partition is a list of sums, one per part. Differencing takes the two partial
partitions with the largest spread (largest sum less smallest) and joins them oppositely
ordered, largest part to smallest, until one is left.

Groups of equal keys are dealt at random over buckets. Each bucket is differenced by one
task to ``units`` nearly equal units; bucket results are differenced with each other in a
tree of bounded fan-in. Groups too large to be evened out inside a bucket, and a bounded
random part of the others, take part one by one in the last differencing, so they fill up
what the units leave uneven. No task sees more than a bounded number of groups.

Nulls: a null text counts no bytes and is in the group of the empty text. Repeated rows
are rows of the same group. Ties are broken by hash. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.llm.frames import parts, running
from sahaf.session import staged

#: Groups in a bucket, parts that a bucket is differenced to, partial partitions joined by one task.
BUCKET_GROUPS, UNITS, FAN_IN = 50_000, 96, 64
#: Groups, at random, that take part one by one in the last differencing, and ranges that number a shard.
SINGLES, RANGES = 20_000, 64
#: A group over this part of a mean shard is placed one by one.
LARGE = 1 / 64


def difference(partials: list[tuple[list[int], list]], k: int) -> list:
    """Nodes of the k parts of the final partition, by falling sum.

    A partial partition is (sums, nodes), both by falling sum; a node is None, a leaf, or
    a pair of nodes that came into the same part.
    """
    heap = [(sums[-1] - sums[0], i, sums, nodes) for i, (sums, nodes) in enumerate(partials)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, at = heapq.heappop(heap)
        _, _, b, bt = heapq.heappop(heap)
        joined = [
            (x + y, n if m is None else m if n is None else (n, m))
            for x, n, y, m in zip(a, at, reversed(b), reversed(bt), strict=True)
        ]
        joined.sort(key=lambda p: -p[0])
        sums, nodes = [p[0] for p in joined], [p[1] for p in joined]
        heapq.heappush(heap, (sums[-1] - sums[0], tie, sums, nodes))
        tie += 1
    return heap[0][3] if heap else [None] * k


def leaves(node) -> Iterator[int]:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack.extend(x)
        elif x is not None:
            yield x


def parts_of(partials: list[tuple[list[int], list]], k: int, n: int) -> np.ndarray:
    """Part of each of the n leaves."""
    out = np.zeros(n, dtype=np.int64)
    for part, node in enumerate(difference(partials, k)):
        for leaf in leaves(node):
            out[leaf] = part
    return out


def single(size: int, leaf: int, k: int) -> tuple[list[int], list]:
    return [size] + [0] * (k - 1), [leaf] + [None] * (k - 1)


def _items(k: int):
    """Difference single items: adds ``part``, in order of the ids so that reruns agree."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        partials = [single(s, i, k) for i, s in enumerate(pdf["size"].tolist())]
        return pdf.assign(part=parts_of(partials, k, len(pdf)))

    return run


def _joined(units: int):
    """Difference whole partial partitions (bucket, part, size): adds ``into``, the part of the result."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "size", "part"], ascending=[True, False, True], ignore_index=True)
        sizes, partials = pdf["size"].tolist(), []
        for _, rows in pdf.groupby("bucket", sort=True).indices.items():
            own = [*rows.tolist(), *[None] * (units - len(rows))]
            partials.append(([0 if i is None else sizes[i] for i in own], own))
        return pdf.assign(into=parts_of(partials, units, len(pdf)))

    return run


def balanced(groups: DataFrame, shards: int) -> DataFrame:
    """(gkey, shard) of groups (gkey, size), with sums of size as equal as differencing gets them."""
    stats = groups.agg(F.count("*"), F.sum("size")).first()
    n, total = stats[0], int(stats[1] or 0)
    item = F.xxhash64("gkey")
    reserve = int(min(1.0, SINGLES / max(n, 1)) * (1 << 20))
    alone = (F.col("size") > total / shards * LARGE) | (F.pmod(F.shiftright(item, 20), F.lit(1 << 20)) < reserve)
    buckets = parts(n, BUCKET_GROUPS)
    dealt = groups.select("gkey", "size", item.alias("item"), alone.alias("alone"))
    dealt = dealt.withColumn("bucket", F.when(F.col("alone"), -1).otherwise(F.pmod(item, F.lit(buckets))).cast("long"))
    dealt = staged(dealt, "shard-groups")

    schema = "gkey string, size long, item long, alone boolean, bucket long, part long"
    inside = dealt.where("bucket >= 0").groupBy("bucket").applyInPandas(_items(UNITS), schema)
    placed = staged(inside.select("gkey", "size", "bucket", "part"), "shard-units")
    level = placed.groupBy("bucket", "part").agg(F.sum("size").alias("size"))
    path = placed.select("gkey", "bucket", "part")
    while buckets > 1:
        joined = level.withColumn("next", F.floor(F.col("bucket") / FAN_IN)).groupBy("next")
        schema = "bucket long, part long, size long, next long, into long"
        step = staged(joined.applyInPandas(_joined(UNITS), schema), "shard-level")
        path = path.join(step.select("bucket", "part", "next", "into"), ["bucket", "part"])
        path = path.select("gkey", F.col("next").alias("bucket"), F.col("into").alias("part"))
        level = step.groupBy(F.col("next").alias("bucket"), F.col("into").alias("part")).agg(F.sum("size").alias("size"))
        buckets = parts(buckets, FAN_IN)

    # At most UNITS units, SINGLES groups at random and shards / LARGE large ones.
    units = level.select(F.lit("").alias("gkey"), "size", F.col("part").alias("item"), F.lit(False).alias("alone"))
    last = units.union(dealt.where("alone").select("gkey", "size", "item", "alone")).withColumn("bucket", F.lit(0).cast("long"))
    schema = "gkey string, size long, item long, alone boolean, bucket long, part long"
    last = staged(last.groupBy("bucket").applyInPandas(_items(shards), schema), "shard-last")
    of_unit = last.where("not alone").select(F.col("item").alias("part"), F.col("part").cast("int").alias("shard"))
    singles = last.where("alone").select("gkey", F.col("part").cast("int").alias("shard"))
    # At most UNITS rows.
    return path.join(F.broadcast(of_unit), "part").select("gkey", "shard").union(singles)


def by_bytes(docs: DataFrame, shards: int, overhead: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of rows (doc_id, text); equal texts share a shard.

    ``size`` is the text's bytes and ``overhead``; ``slot`` numbers a shard's rows from 0.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    sized = docs.select(
        "doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("gkey"),
    )
    sized = staged(sized, "shard-rows")
    places = balanced(sized.groupBy("gkey").agg(F.sum("size").alias("size")), shards)
    placed = sized.join(places, "gkey").drop("gkey")
    key = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 1)
    ties = ["doc_id", "text_crc32", "size"]
    placed = staged(placed.withColumn("key", key), "shard-placed")
    out = running(placed, "shard", "key", F.lit(1), ties, parts(placed.count(), RANGES * 20_000) * RANGES, "slot")
    return out.withColumn("slot", F.col("slot").cast("long")).drop("key")
