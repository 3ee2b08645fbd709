"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Principal axes and a rotation are learned on a bounded sample so that the signs of the
rotated vectors are balanced codes of small quantisation error. Codes are cut into
substrings; vectors of a class that agree in a substring meet in a bucket of its table,
and are compared there by cosine in double precision. A pair counts in the first table
where it meets. Buckets that are too large are split into blocks of pairs of chunks.

Only vectors of the same, not null, label and the same length are compared; each length
has a model of its own. Vectors that are null, empty, zero, or hold a null or non-finite
number link with nothing. Equal vectors of a label are one node with a weight; rows of one
vec_id are one node as well. A pair at the threshold itself links. Very long vectors are
compared whole. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.llm.frames import components, runs
from sahaf.session import staged

#: Rows at most, about, that axes and rotation are learned on.
SAMPLE = 8_192
#: Wanted vectors of a class in a bucket, least and most bits of a substring, rows of a chunk.
BUCKET, LEAST_BITS, MOST_BITS, CHUNK = 32, 8, 20, 256
#: Wanted chance that a pair at the threshold meets in some table, and most rotations that are learned for it.
RECALL, MOST_ROTATIONS = 0.985, 64
MIN_COSINE = 0.93


def usable(vec: Column, dim: int) -> Column:
    """Whether a vector can be compared."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == dim) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; the largest number is divided out first."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def spread_out(sample: np.ndarray, planes: int = 12, seed: int = 11) -> np.ndarray:
    """One vector of the sample for each cell of a few random planes.

    A large group of near copies has few cells. Left whole it would draw the thresholds,
    which halve the sample, through its own middle, and copies would differ in every bit.
    """
    normals = np.random.default_rng(seed).standard_normal((sample.shape[1], planes))
    cells = (unit(sample) @ normals >= 0) @ (1 << np.arange(planes))
    return sample[np.unique(cells, return_index=True)[1]]


def fit(sample: np.ndarray, rotations: int, steps: int = 40, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """(projection, threshold) of each code: signs of x @ projection - threshold, half of them positive."""
    x = unit(sample)
    mean = x.mean(axis=0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(64, x.shape[1])]
    v = centred @ axes
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(rotations):
        r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        projection = axes @ r
        out.append((projection, np.median(x @ projection, axis=0)))
    return out


def at_threshold(sample: np.ndarray, min_cosine: float, pairs: int = 4_000, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of exactly that cosine: sampled vectors, and partners of them in random directions."""
    rng = np.random.default_rng(seed)
    x = unit(sample)[rng.integers(0, len(sample), pairs)]
    if x.shape[1] < 2:
        return x, x
    away = rng.standard_normal(x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    return x, min_cosine * x + math.sqrt(1 - min_cosine**2) * away


def layout(largest: int, min_cosine: float, sample: np.ndarray) -> tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]:
    """Bits of a substring, number of tables, and the codes: enough that a pair at the threshold meets with chance RECALL.

    The chance is measured on pairs made at the threshold: codes are centred, so vectors with
    a large common mean differ in more signs than the angle between them tells.
    """
    width = min(64, sample.shape[1])
    bits = min(max(LEAST_BITS, math.ceil(math.log2(max(largest, 1) / BUCKET + 1))), MOST_BITS, width)
    per, (x, y) = width // bits, at_threshold(sample, min_cosine)
    rotations = 1
    while True:
        model = fit(sample, rotations)
        met = keys_of(x, model, bits, per * rotations) == keys_of(y, model, bits, per * rotations)
        reached = np.maximum.accumulate(met, axis=1).mean(axis=0)
        enough = np.flatnonzero(reached >= RECALL)
        if len(enough) or rotations >= MOST_ROTATIONS:
            return bits, int(enough[0]) + 1 if len(enough) else per * rotations, model
        rotations = min(2 * rotations, MOST_ROTATIONS)


def keys_of(vectors: np.ndarray, model: list[tuple[np.ndarray, np.ndarray]], bits: int, tables: int) -> np.ndarray:
    """(n, tables) substrings of the codes as numbers."""
    x = unit(vectors)
    signs = np.concatenate([x @ p >= t for p, t in model], axis=1)
    own = min(signs.shape[1] // len(model), signs.shape[1])
    per = own // bits
    columns = [(t // per) * own + (t % per) * bits for t in range(tables)]
    place = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([signs[:, c : c + bits] @ place for c in columns], axis=1)


def linked(own: np.ndarray, min_cosine: float, other: np.ndarray | None = None) -> np.ndarray:
    """Which pairs of unit vectors are as near as the threshold."""
    return own @ (own if other is None else other).T >= min_cosine


def local_roots(link: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable within a block, by passing on minima until nothing changes."""
    root = ids.copy()
    while True:
        near = np.where(link, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(root, near)
        if (new == root).all():
            return root
        root = new


def compare(min_cosine: float):
    """Links in each bucket or block: rows (node, links, to) of those that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["label", "bucket", "x", "y"]):
            rows = rows.combine_chunks()
            column = {c: rows.column(c).to_numpy() for c in ("label", "bucket", "x", "y", "chunk", "table", "node", "weight")}
            flat = rows.column("vec").chunk(0) if rows.column("vec").num_chunks else None
            if flat is None:
                continue
            vectors = flat.flatten().to_numpy().reshape(len(rows), -1)
            keys = rows.column("keys").chunk(0).flatten().to_numpy().reshape(len(rows), -1)
            changed = np.ones(len(rows), dtype=bool)
            changed[1:] = np.any([column[c][1:] != column[c][:-1] for c in ("label", "bucket", "x", "y")], axis=0)
            cuts = [*np.flatnonzero(changed).tolist(), len(rows)]
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a < 2:
                    continue
                v = unit(vectors[a:b])
                link = linked(v, min_cosine)
                np.fill_diagonal(link, False)
                if column["x"][a] != column["y"][a]:
                    side = column["chunk"][a:b] == column["x"][a]
                    link &= side[:, None] != side[None, :]
                if not link.any():
                    continue
                ids = column["node"][a:b]
                i, j = np.nonzero(link)
                t = int(column["table"][a])
                k = keys[a:b]
                new = ~(k[i, :t] == k[j, :t]).any(axis=1)
                counts = np.bincount(i[new], weights=column["weight"][a:b][j[new]], minlength=b - a).astype(np.int64)
                any_link = link.any(axis=1)
                roots = local_roots(link, ids)
                out[0].append(ids[any_link])
                out[1].append(counts[any_link])
                out[2].append(roots[any_link])
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "links", "to"])

    return run


def near_duplicates(rows: DataFrame, min_cosine: float = MIN_COSINE, dim: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of rows (vec_id, embedding, label); ``dim`` leaves out vectors of other lengths."""
    rows = rows.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    lengths = [dim]
    if dim is None:
        # One number for each length that occurs.
        lengths = sorted(r[0] for r in rows.where("size(embedding) > 0").select(F.size("embedding")).distinct().collect())
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = [x for x in (of_length(rows, n, min_cosine) for n in lengths) if x is not None]
    if not found:
        return alone
    known = found[0]
    for other in found[1:]:
        known = known.union(other)
    # Equal vectors are many rows of one node: this join is split where one vector has very many.
    out = rows.join(known, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def of_length(rows: DataFrame, dim: int, min_cosine: float) -> DataFrame | None:
    """(label, embedding, n_links, component_id) of the different vectors of one length; None where there are none."""
    good = rows.where(usable(F.col("embedding"), dim) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    groups = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    nodes = staged(groups, "itq-nodes")
    stats = nodes.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    if not stats[0]:
        return None
    share = min(1.0, SAMPLE / stats[0])
    drawn = F.pmod(F.xxhash64("label", "embedding"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = nodes.where(drawn).select("embedding").limit(2 * SAMPLE).toArrow().column(0).combine_chunks()
    sample = sample.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    sample = spread_out(sample)
    bits, tables, model = layout(stats[1], min_cosine, sample)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            keys = keys_of(flat, model, bits, tables)
            at = pa.array(np.arange(batch.num_rows + 1) * tables, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(at, pa.array(keys.ravel(), pa.int64()))],
                names=["node", "label", "weight", "vec", "keys"],
            )

    plain = nodes.select("node", "label", "weight", F.col("embedding").alias("vec"))
    coded = plain.mapInArrow(code, "node long, label long, weight long, vec array<float>, keys array<long>")
    coded = staged(coded, "itq-codes")
    spread = coded.select("*", F.posexplode("keys").alias("table", "key"))
    bucket = (F.col("table").cast("long") * (1 << 40) + F.col("key")).alias("bucket")
    spread = spread.select("node", "label", "weight", "vec", "keys", "table", bucket)
    crowded = spread.groupBy("label", "bucket").count().where(F.col("count") > 2 * CHUNK)
    crowded = staged(crowded.select("label", "bucket", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")), "itq-crowded")
    met = spread.join(crowded, ["label", "bucket"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    met = met.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.withColumn("x", F.least("chunk", "with")).withColumn("y", F.greatest("chunk", "with")).drop("with", "chunks")
    keys = ["label", "bucket", "x", "y"]
    met = met.repartition(*keys).sortWithinPartitions(*keys)
    found = staged(met.mapInArrow(compare(min_cosine), "node long, links long, to long"), "itq-links")

    roots = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")), "itq-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    return nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
