"""Importance resampling towards a target: hashed n-gram gains, an exact weighted selection, a sorted draw.

Features of a text are its runs of one and two words, in ``BUCKETS`` buckets by CRC-32.
Bucket counts of the documents and of the target texts are sums over all of them: each
task counts into one array and gives one row a bucket. The gains of the buckets, one array
of fixed size, score every document in its task. A document's key is its weight with a
Gumbel noise drawn from its id, so the highest keys are a draw without replacement.

The key at the cutoff is found by weighted medians of medians. Each file range of the
written keys gives the median of its keys that are left; the median of these, weighted by
how many keys each range has left, has at least a quarter of all on either side, so each
pass discards at least that. The pass that counts the keys on both sides of one pivot
also gives the medians of both sides, so there is one job a pass. Keys are written anew
whenever seven of eight are gone; what is left under ``FEW`` is sorted.

Nulls: a null text has no words; a null id draws by the empty string and comes last among
equal scores. Long texts are scored whole. Ties: equal scores go by smaller id, then by
fewer features, then by the order in which rows were written; no key is equal to another,
so a hot id or score can be split. Repeated rows are documents of their own. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.frames import parts
from sahaf.llm.words import _LOWER, blocks, raw
from sahaf.session import staged

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Keys that are sorted at once when so few are left; rows of a range of the sorted winners.
FEW, RANGE_ROWS = 4_096, 250_000
#: Longer words are hashed one by one.
LONG = 64

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True


def _byte_table() -> np.ndarray:
    """CRC-32 of each byte after a register of 0, from the reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CRC = _byte_table()


def _shift_tables() -> np.ndarray:
    """[n, k, b]: what byte k of a CRC-32, being b, becomes when n bytes follow it."""
    out = np.zeros((LONG + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for n in range(1, LONG + 1):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ _CRC[out[n - 1] & np.uint32(255)]
    return out


_SHIFT = _shift_tables()


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of byte spans, one place of all spans at a time."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    begin, left = starts[order], size[order]
    register = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(int(min(left[0], LONG)) if len(left) else 0):
        some = int(np.searchsorted(-left, -j, side="left"))
        register[:some] = (register[:some] >> np.uint32(8)) ^ _CRC[(register[:some] ^ data[begin[:some] + j]) & np.uint32(255)]
    out = np.empty(len(starts), dtype=np.uint32)
    out[order] = register ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, the texts' len + 1 offsets in them; buckets of all word pairs, and the row of each."""
    data, offsets = raw(texts)
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    one = word_crcs(data, starts, ends)
    at = np.searchsorted(starts, offsets)
    first = np.ones(len(starts) + 1, dtype=bool)
    first[1:] = False
    first[at] = True
    second = np.flatnonzero(~first[:-1])
    spaced = one[second - 1] ^ np.uint32(0xFFFFFFFF)
    spaced = (spaced >> np.uint32(8)) ^ _CRC[(spaced ^ np.uint32(32)) & np.uint32(255)] ^ np.uint32(0xFFFFFFFF)
    size = (ends - starts)[second]
    n = np.minimum(size, LONG)
    two = one[second].copy()
    for k in range(4):
        two ^= _SHIFT[n, k, (spaced >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(size > LONG):
        two[i] = zlib.crc32(data[starts[second[i]] : ends[second[i]]].tobytes(), int(spaced[i]))
    row = np.searchsorted(at, second, side="right") - 1
    return one % np.uint32(BUCKETS), at, two % np.uint32(BUCKETS), row


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts (text) fall into each bucket: at most BUCKETS rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                one, _, two, _ = features(batch.column(0).slice(a, b - a))
                total += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some.astype(np.int32), "n": total[some]})

    rows = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, floored."""
    every_doc, every_target = int(docs.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (every_doc + BUCKETS) / ((s + 1) * (every_target + BUCKETS))))
         for s, t in zip(docs.tolist(), target.tolist(), strict=True)],
        dtype=np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, row) of documents (doc_id, text); ``row`` differs in each."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, row = sent.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                one, at, two, of = features(batch.column(1).slice(a, b - a))
                n_words, n = np.diff(at), b - a
                n_features = n_words + np.maximum(n_words - 1, 0)
                sums = np.concatenate(([0], np.cumsum(values[one])))
                pairs = np.concatenate(([0], np.cumsum(values[two])))
                cut = np.searchsorted(of, np.arange(n + 1))
                total = np.diff(sums[at]) + np.diff(pairs[cut])
                columns = [batch.column(0).slice(a, n), n_words, n_features, total // np.maximum(n_features, 1), row + np.arange(n)]
                yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names=names)
                row += n

    names = ["doc_id", "n_words", "n_features", "weight", "row"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, row long")


def noise(seed: int) -> Column:
    """Thousandths of a Gumbel number from the id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


#: A key: numbers that rise from the best document to the worst; no two are equal.
KEY = ["fall", "nameless", "id", "n_features", "row"]


def before(key: tuple[int, ...]) -> Column:
    """Whether a row's key comes before ``key``."""
    out = F.lit(False)
    for name, value in reversed(list(zip(KEY, key, strict=True))):
        own = F.col(name)
        out = (own < value) | ((own == value) & out)
    return out


def _before(columns: list[np.ndarray], key: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(columns[0]), dtype=bool)
    for own, value in reversed(list(zip(columns, key, strict=True))):
        out = (own < value) | ((own == value) & out)
    return out


def pass_over(keys: DataFrame, low: tuple | None, high: tuple | None, pivot: tuple | None) -> list[tuple[bool, int, tuple]]:
    """(under the pivot, count, median) of each side and task, of the keys k with low <= k < high.

    Without a pivot all of them count as under it. Two rows a task come back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keep = np.ones(batch.num_rows, dtype=bool)
            if low is not None:
                keep &= ~_before(columns, low)
            if high is not None:
                keep &= _before(columns, high)
            if keep.any():
                held.append([c[keep] for c in columns])
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        under = np.ones(len(columns[0]), dtype=bool) if pivot is None else _before(columns, pivot)
        rows = []
        for side in (True, False):
            own = [c[under == side] for c in columns]
            if len(own[0]):
                middle = np.lexsort(own[::-1])[len(own[0]) // 2]
                rows.append([side, len(own[0]), *[int(c[middle]) for c in own]])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["under", "n", *KEY])

    schema = "under boolean, n long, " + ", ".join(f"{k} long" for k in KEY)
    found = keys.select(*KEY).mapInArrow(run, schema).collect()
    return [(r["under"], r["n"], tuple(r[k] for k in KEY)) for r in found]


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The first median up to which the ranges hold more than half of all keys."""
    medians = sorted(medians, key=lambda m: m[1])
    half, so_far = sum(n for n, _ in medians) / 2, 0
    for n, key in medians:
        so_far += n
        if so_far > half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, wanted: int) -> tuple | None:
    """The first key that is not among the ``wanted`` first ones; None where all are."""
    low = high = pivot = None
    found = pass_over(keys, None, None, None)
    left = sum(n for _, n, _ in found)
    if wanted >= left:
        return None
    stored = left
    while left > FEW:
        pivot = weighted_median([(n, key) for _, n, key in found])
        sides = pass_over(keys, low, high, pivot)
        under = sum(n for side, n, _ in sides if side)
        # A quarter at least lies under the pivot, which itself is on the other side: neither side is all that was left.
        if wanted < under:
            high, left = pivot, under
        else:
            low, left, wanted = pivot, left - under, wanted - under
        found = [m for m in sides if m[0] == (high == pivot)]
        if left * 8 < stored and left > FEW:
            keys = staged(_between(keys, low, high), "resampling-left")
            stored = left
    rows = _between(keys, low, high).select(*KEY).collect()
    return sorted(tuple(r) for r in rows)[wanted]


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    inside = F.lit(True) if low is None else ~before(low)
    return keys.where(inside if high is None else inside & before(high))


def ranked(winners: DataFrame, n: int) -> DataFrame:
    """Adds ``rank`` by rising key: sorted by ranges, numbered within each, and the ranges' sizes summed in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            numbers = [np.full(batch.num_rows, part, dtype=np.int32), place + np.arange(batch.num_rows, dtype=np.int64)]
            place += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, numbers)], names=[*names, "part", "place"])

    names = winners.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in winners.schema) + ", part int, place long"
    rows = winners.repartitionByRange(parts(n, RANGE_ROWS), *KEY).sortWithinPartitions(*KEY)
    rows = staged(rows.mapInArrow(run, schema), "resampling-ranges")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each quarter of a million winners.
    start = staged(sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "resampling-starts")
    return rows.join(start, "part").withColumn("rank", F.col("start") + F.col("place") + 1)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of documents (doc_id, text), drawn towards the target texts (text).

    Of the N documents of at least ``least_words`` words, floor(percent N / 100) are drawn;
    the others have no rank.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + noise(seed))
    scored = scored.withColumn("fall", -F.col("score")).withColumn("nameless", F.col("doc_id").isNull().cast("long"))
    scored = staged(scored.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0))), "resampling-scores")
    able = scored.where(F.col("n_words") >= least_words)
    wanted = percent * able.count() // 100
    limit = cutoff(able, wanted) if wanted else ()
    won = F.lit(False) if limit == () else F.lit(True) if limit is None else before(limit)
    won = (F.col("n_words") >= least_words) & won
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(scored.where(won).select(*columns, *[k for k in KEY if k not in columns]), wanted).select(*columns, "rank")
    return drawn.union(scored.where(~won).select(*columns, F.lit(None).cast("long").alias("rank")))
