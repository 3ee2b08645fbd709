"""Exact Jaccard join of word shingle sets by adaptive multi-match prefixes.

All sets are put in one order, rare shingles first. Two sets whose overlap is at least
t(n) = the least overlap that a set of n shingles needs share at least l shingles within
their first n - t(n) + l ones. Each document chooses its own l between 1 and MOST_MATCHES
by estimated cost: a longer prefix moves more rows, but as more shared shingles are
required, fewer candidates are verified. A pair shares at least as many prefix shingles
as the smaller l of the two. More is known: of the two prefixes' last shingles take the
one that comes first in the order; common shingles up to it are in both prefixes, and of
its set only t(n) - l shingles come later. So a pair that must share o shingles in all
shares at least o - t(n) + l of them in the prefixes; others are no candidates.

How frequent a shingle is comes from a table of counters of fixed size over all
documents; it only sets the order and the estimates, never the result.

Groups of many near copies are joined up first: every prefix shingle that holds more
than one component offers one leader, and only pairs with it are verified. The leader is
the set of which the largest part of the prefix is shared with others: an edited copy
begins with shingles of its own, the text that it was made from does not.
Then all pairs of different components that are still candidates are verified. Pairs
within a component are never made.

Sets with equal shingles are one node, a 64-bit hash of the set. Nulls: a null text is
empty; a document without words links with nothing; a null id is kept and counts last.
Equal rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.llm.frames import components, parts, runs
from sahaf.llm.words import _PLACE, K, blocks, mixed, shingles
from sahaf.session import staged

#: Similarity in percent; most shared shingles asked for; cost of a candidate in prefix rows.
PERCENT, MOST_MATCHES, CANDIDATE_COST = 80, 4, 8.0
#: Counters of shingle frequency, and rounds in which leaders are offered.
COUNTERS, LEADER_ROUNDS = 1 << 18, 1
#: Prefix rows of a task, rows of one shingle in one run, rows of a chunk of a group when all pairs are made.
TASK_ROWS, RUN_ROWS, CHUNK = 1_000_000, 50_000, 4_096
#: Bits of the table by which documents that need no verification are passed over.
FILTER_BITS = 1 << 23
_SHIFT = np.uint64(64 - 18)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n must share with any set as similar."""
    return -(-n * percent // 100)


def nodes_of(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set of hashes."""
    n = np.diff(at)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(h * _PLACE[61]))))
    return mixed(sums[at[1:]] - sums[at[:-1]] + n.astype(np.uint64) * _PLACE[60]).view(np.int64)


def sets_and_counts(k: int):
    """First pass: a row (0, doc_id, shingles, node) per document, and (1, counter, count, null) per counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        names = ["kind", "id", "n", "node"]
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                h, at = shingles(batch.column(1).slice(a, b - a), k)
                counts += np.bincount((h >> _SHIFT).astype(np.int64), minlength=COUNTERS)
                n = np.diff(at)
                node = pa.array(nodes_of(h, at), mask=n == 0)
                kind = pa.array(np.zeros(b - a, np.int8))
                yield pa.RecordBatch.from_arrays([kind, batch.column(0).slice(a, b - a), pa.array(n), node], names=names)
        used = np.flatnonzero(counts)
        columns = [np.ones(len(used), np.int8), used, counts[used]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(used), pa.int64())], names=names)

    return run


def matches(excess: np.ndarray, short: int, n: int, t: int) -> int:
    """How many shared prefix shingles a document asks for: the cheapest by estimate.

    ``excess`` has, for each shingle of the prefix in order, how many other documents are
    thought to have it; ``short`` is the length of the prefix for one match.
    """
    most = min(MOST_MATCHES, t, n - short + 1)
    if most <= 1:
        return 1
    sums = np.cumsum(excess)
    lengths = short + np.arange(most)
    cost = lengths + sums[lengths - 1] * (1 + CANDIDATE_COST / (1 + np.arange(most)))
    return int(cost.argmin()) + 1


def prefixes(counts, noise: int, k: int, percent: int):
    """Second pass: rows (token, node, meta) of each distinct set's prefix; meta is 8 n + l."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = counts.value
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                h, at = shingles(batch.column(1).slice(a, b - a), k)
                nodes = nodes_of(h, at)
                _, first = np.unique(nodes, return_index=True)
                rank = df[(h >> _SHIFT).astype(np.int64)]
                tokens, owners, metas = [], [], []
                for d in first.tolist():
                    x, y = int(at[d]), int(at[d + 1])
                    n = y - x
                    if not n:
                        continue
                    t = -(-n * percent // 100)
                    short = n - t + 1
                    own = rank[x:y]
                    order = np.argsort(own, kind="stable")[: min(n, short + MOST_MATCHES - 1)]
                    l = matches(np.maximum(own[order] - noise, 0), short, n, t)
                    order = order[: min(n, short + l - 1)]
                    tokens.append(h[x:y][order])
                    owners.append((int(nodes[d]), len(order)))
                    metas.append(8 * n + l)
                if tokens:
                    sizes = [s for _, s in owners]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens).view(np.int64)),
                            pa.array(np.repeat(np.array([o for o, _ in owners], np.int64), sizes)),
                            pa.array(np.repeat(np.array(metas, np.int64), sizes)),
                        ],
                        names=["token", "node", "meta"],
                    )

    return run


def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tokens that two sets have, without repeated rows; a part of a split token is kept as it is."""
    for rows in runs(batches, ["token", "part"]):
        token, part, node, meta = (rows.column(c).to_numpy() for c in ("token", "part", "node", "meta"))
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
        fresh = new.copy()
        fresh[1:] |= node[1:] != node[:-1]
        run_of = np.cumsum(new)[fresh] - 1
        size = np.bincount(run_of)
        keep = np.flatnonzero(fresh)[(size[run_of] > 1) | (part[fresh] >= 0)]
        if len(keep):
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (token, node, meta)], names=["token", "node", "meta"])


def needed(ma: np.ndarray, mb: np.ndarray, percent: int) -> np.ndarray:
    """How many prefix shingles a pair must share."""
    n, m = ma >> 3, mb >> 3
    whole = -(-(n + m) * percent // (100 + percent))
    return np.minimum(whole - least_overlap(n, percent) + (ma & 7), whole - least_overlap(m, percent) + (mb & 7))


def all_pairs(percent: int):
    """Pairs of different components in each block, within the length limits, and how many tokens they share there.

    ``total`` is how many tokens of a set are in any block. What a set has elsewhere bounds
    how many more a pair can share; pairs that can't come to enough are not passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["low", "x", "y"]):
            c = {k: rows.column(k).to_numpy() for k in ("low", "x", "y", "token", "chunk", "node", "meta", "root", "total")}
            changed = np.ones(len(rows), dtype=bool)
            changed[1:] = np.any([c[k][1:] != c[k][:-1] for k in ("low", "x", "y", "token")], axis=0)
            cuts = np.append(np.flatnonzero(changed), len(rows))
            nodes, first, place = np.unique(c["node"], return_index=True, return_inverse=True)
            codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            # Runs of equal size are done together.
            sizes = np.diff(cuts)
            for s in np.unique(sizes[sizes > 1]).tolist():
                starts = cuts[:-1][sizes == s]
                i, j = np.triu_indices(s, 1)
                step = max(1, 2_000_000 // len(i))
                for k in range(0, len(starts), step):
                    own = starts[k : k + step]
                    p, q = (own[:, None] + i).ravel(), (own[:, None] + j).ravel()
                    ok = c["root"][p] != c["root"][q]
                    n, m = c["meta"][p] >> 3, c["meta"][q] >> 3
                    ok &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
                    ok &= (c["x"][p] == c["y"][p]) | (c["chunk"][p] != c["chunk"][q])
                    p, q = place[p[ok]], place[q[ok]]
                    new = np.minimum(p, q) * len(nodes) + np.maximum(p, q)
                    codes, at = np.unique(np.concatenate((codes, new)), return_inverse=True)
                    counts = np.bincount(at, np.concatenate((counts, np.ones(len(new), np.int64))), len(codes)).astype(np.int64)
            if len(codes):
                p, q = codes // len(nodes), codes % len(nodes)
                meta = c["meta"][first]
                # A table may hold several blocks of a set; counting them all as one keeps the bound safe
                # only for a single block, so elsewhere is taken from the block where the set has fewest.
                block = np.cumsum(np.append(True, np.any([c[k][1:] != c[k][:-1] for k in ("low", "x", "y")], axis=0)))
                each, rows_there = np.unique(block * len(nodes) + place, return_counts=True)
                here = np.full(len(nodes), np.iinfo(np.int64).max)
                np.minimum.at(here, each % len(nodes), rows_there)
                more = c["total"][first] - here
                enough = counts + np.minimum(more[p], more[q]) >= needed(meta[p], meta[q], percent)
                p, q, counts = p[enough], q[enough], counts[enough]
                columns = [nodes[p], meta[p], nodes[q], meta[q], counts]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["a", "ma", "b", "mb", "c"])

    return run


def candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from rows (a, ma, b, mb, c) with counts of shared prefix shingles: those that share enough."""
    n, m = F.shiftright("ma", 3), F.shiftright("mb", 3)
    whole = F.ceil((n + m) * percent / (100 + percent))
    first = whole - F.ceil(n * percent / 100) + F.col("ma").bitwiseAND(7)
    second = whole - F.ceil(m * percent / 100) + F.col("mb").bitwiseAND(7)
    met = met.where(100 * F.least(n, m) >= percent * F.greatest(n, m))
    counted = met.groupBy("a", "ma", "b", "mb").agg(F.sum("c").alias("c"))
    return counted.where(F.col("c") >= F.least(first, second)).select("a", "b")


def wanted_sets(bits, k: int):
    """Third pass: (node, shingles) of the documents whose id is in the table of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            batch = batch.filter(pa.array(table[batch.column(2).to_numpy()]))
            for a, b in blocks(batch.column(1)):
                h, at = shingles(batch.column(1).slice(a, b - a), k)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes_of(h, at)), lists], names=["node", "shingles"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their whole sets.

    ``chosen`` has one document (node, id) of each set. Only documents whose id falls on a
    set bit of a table of fixed size are shingled again; others that fall on the same bit
    meet no pair.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).cast("long").alias("slot")
    slots = chosen.join(needed, "node").select(slot).distinct().toArrow().column(0).to_numpy()
    table = np.zeros(FILTER_BITS, dtype=bool)
    table[slots] = True
    bits = docs.sparkSession.sparkContext.broadcast(table)
    rows = docs.select("id", "text", slot)
    sets = staged(rows.mapInArrow(wanted_sets(bits, k), "node long, shingles array<long>"), "join-sets")
    left = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("other")), "b")
    both = left.join(sets.select(F.col("node").alias("a"), "shingles"), "a")
    inter = F.size(F.array_intersect("shingles", "other"))
    union = F.size("shingles") + F.size("other") - inter
    return staged(both.where(100 * inter >= percent * union).select("a", "b"), "join-links")


def similar_groups(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").alias("id"), "text")
    first = staged(docs.mapInArrow(sets_and_counts(k), "kind byte, id long, n long, node long"), "join-sets-counts")
    members = first.where("kind = 0").select("id", "n", "node")
    found = first.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[found.column(0).to_numpy()] = found.column(1).to_numpy()
    noise = int(np.median(counts) + 3 * np.sqrt(np.median(counts)))
    sent = spark.sparkContext.broadcast(counts)
    postings = docs.mapInArrow(prefixes(sent, noise, k, percent), "token long, node long, meta long")
    rows = int(counts.sum()) * (100 - percent) // 100 + 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts(rows, TASK_ROWS))
    # A shingle that is counted very often is split by node; its parts meet again below.
    hot = np.flatnonzero(counts > noise + RUN_ROWS)
    part = F.lit(-1)
    if len(hot):
        split = F.pmod("node", F.lit(int(counts.max() // RUN_ROWS + 1))).cast("int")
        counter = F.shiftrightunsigned("token", 64 - 18)
        part = F.when(counter.isin([int(x) for x in hot[:4096]]), split).otherwise(-1) if len(hot) <= 4096 else split
    postings = postings.withColumn("part", part.cast("int")).repartition(tasks, "token", "part")
    postings = postings.sortWithinPartitions("token", "part", "node")
    kept = staged(postings.mapInArrow(shared, "token long, node long, meta long"), "join-shared")

    chosen = staged(members.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id")), "join-chosen")
    n, t = F.shiftright("meta", 3), F.ceil(F.shiftright("meta", 3) * percent / 100)
    alone = 1 - F.count("*") / F.first(n - t + F.col("meta").bitwiseAND(7))
    nodes = staged(kept.groupBy("node").agg(alone.alias("alone")), "join-nodes")
    roots = nodes.withColumn("root", F.col("node"))
    links, done = None, None
    for number in range(LEADER_ROUNDS + 1):
        rows = kept.join(roots, "node")
        lead = F.min(F.struct("alone", F.xxhash64("node", F.lit(number)).alias("h"), "node", "meta", "root"))
        tokens = rows.groupBy("token").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"), lead.alias("lead")
        )
        tokens = tokens.where("low <> high")
        if number < LEADER_ROUNDS:
            met = rows.join(tokens.select("token", "lead"), "token").where("root <> lead.root")
            own, lead = F.struct("node", "meta"), F.struct("lead.node", "lead.meta")
            low, high = F.least(own, lead), F.greatest(own, lead)
            met = met.select(
                low["node"].alias("a"), low["meta"].alias("ma"), high["node"].alias("b"), high["meta"].alias("mb"),
                F.lit(1).alias("c"),
            )
        else:
            # Tokens with the same smallest component are together, so that a pair's shared
            # tokens are counted before it is passed on; groups of many rows are cut by node.
            groups = tokens.groupBy("low").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("chunks"))
            met = rows.join(tokens.select("token", "low").join(groups, "low"), "token")
            met = met.join(met.groupBy("node").agg(F.count("*").alias("total")), "node")
            met = met.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            met = met.withColumn("x", F.least("chunk", "with")).withColumn("y", F.greatest("chunk", "with"))
            met = met.select("low", "x", "y", "token", "chunk", "node", "meta", "root", "total")
            met = met.repartition("low", "x", "y").sortWithinPartitions("low", "x", "y", "token")
            met = met.mapInArrow(all_pairs(percent), "a long, ma long, b long, mb long, c long")
        pairs = candidates(met, percent)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = staged(pairs, "join-candidates")
        new = verified(pairs, docs, chosen, k, percent)
        links = new if links is None else links.union(new)
        done = pairs if done is None else done.union(pairs)
        found_roots = components(links, "join-components")
        roots = nodes.join(found_roots, "node", "left")
        roots = staged(roots.select("node", "alone", F.coalesce("root", "node").alias("root")), "join-roots")
    # The smallest id of a component: minima are combined before they meet.
    placed = members.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"))
    out = placed.join(least, "root", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
