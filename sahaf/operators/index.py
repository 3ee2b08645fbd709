"""A term index that is kept: TF-IDF search without reading the corpus.

``add_segment`` tokenises documents once and writes their counts. ``publish`` merges all
segments, takes the weights of the whole corpus and writes the index as one version.
Documents are dealt over shards of about SHARD_DOCS and numbered in each; a term has, for
each shard, blocks of BLOCK postings (number, share of the document's unit vector), with
the largest share of each block. A search reads the blocks of its own terms, which lie in
one bucket of files each, and moves them to their shards. A task bounds what a stretch of
documents can reach by the blocks' maxima, begins with the most promising stretches, and
leaves out those that can't reach the k-th best any more.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sahaf.operators.nearest import best_hits
from sahaf.operators.terms import SENT_TERMS, TermModel, _entries, term_counts, weigh, weigh_queries
from sahaf.session import staged
from sahaf.sources import versions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents of a shard, about; postings of a block; documents of a stretch; buckets of terms.
SHARD_DOCS, BLOCK, STRETCH, BUCKETS = 20_000, 128, 256, 64
#: Terms of the queries that are searched for at once.
SLICE_TERMS = 50_000
#: Scores are rounded to ten places: a stretch is left out only where it stays below the k-th best by more.
MARGIN = 1e-9


def add_segment(docs: DataFrame, folder: str, mode: str = "unicode") -> None:
    """Add documents (doc_id, text) to the index's source; searches see them after ``publish``.

    Rows without ``doc_id`` count as documents but are never found, as in ``tfidf_search``.
    """
    name = uuid.uuid4().hex
    term_counts(docs, mode, move_texts=True).write.parquet(f"{folder}/segments/{name}/counts")
    docs.agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/segments/{name}/size")


def publish(spark: SparkSession, folder: str) -> int:
    """Merge all segments into a new version of the index and return its number.

    ``versions.Conflict`` where another writer published meanwhile.
    """
    base = (versions.numbers(spark, folder) or [0])[-1]
    segments = versions.children(spark, f"{folder}/segments")
    if not segments:
        raise FileNotFoundError(f"no segment in {folder}")
    counts = spark.read.parquet(*[f"{folder}/segments/{s}/counts" for s in segments])
    if _in_parts(counts, segments):
        counts = staged(counts.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")), "counts")
    n = spark.read.parquet(*[f"{folder}/segments/{s}/size" for s in segments]).agg(F.sum("n")).first()[0]
    name = uuid.uuid4().hex
    place = f"{folder}/index/{name}"
    terms = counts.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))
    terms = terms.withColumn("idf", F.log((F.lit(n) + 1) / (F.col("df") + 1)))
    terms.sortWithinPartitions("term").write.parquet(f"{place}/terms")
    model = TermModel(spark.read.parquet(f"{place}/terms"), F.lit(n))

    weighed = weigh(counts, model, SENT_TERMS)
    ids = staged(weighed.where("weight > 0").select("doc_id").distinct(), "ids")
    shards = max(1, -(-ids.count() // SHARD_DOCS))
    # About SHARD_DOCS documents in each window, dealt by hash. The counts of a shard move once, to the task that
    # gathers and numbers its documents and makes its blocks; with four partitions a shard few tasks get two.
    inside = Window.partitionBy("shard").orderBy("doc_id")
    shard, number = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), (F.row_number().over(inside) - 1).alias("no")
    named = ids.select(shard, "doc_id").repartition("shard").select("shard", "doc_id", number)
    named.sortWithinPartitions("shard", "no").write.parquet(f"{place}/documents")
    entries = _entries(weighed.select(shard, "doc_id", "term", "weight").repartition(4 * shards, "shard"), ["shard", "doc_id"], F.lit(True))
    postings = entries.select("shard", number, "entries").select("shard", "no", F.inline("entries"))
    lists = postings.groupBy("shard", "term").agg(F.sort_array(F.collect_list(F.struct("no", "weight"))).alias("p"))
    starts = F.sequence(F.lit(1), F.size("p"), F.lit(BLOCK))
    blocks = lists.select("shard", "term", F.explode(F.transform(starts, lambda i: F.slice("p", i, BLOCK))).alias("b"))
    blocks = blocks.select(
        "shard", "term", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.col("b")[0]["no"].alias("first"), F.array_max("b.weight").alias("top"), F.col("b.no").alias("nos"), F.col("b.weight").alias("shares"),
    )
    blocks.sortWithinPartitions("bucket", "term", "shard", "first").write.partitionBy("bucket").parquet(f"{place}/blocks")
    return versions.commit(spark, folder, base, {"name": name, "documents": n, "shards": shards, "segments": segments})


def _in_parts(counts: DataFrame, segments: list[str]) -> bool:
    """Whether a document came in several segments, so that its counts have to be added up."""
    if len(segments) < 2:
        return False
    name = F.regexp_extract(F.col("_metadata.file_path"), "/segments/([^/]+)/counts/", 1)
    held = counts.select("doc_id", F.array_position(F.array(*map(F.lit, segments)), name).alias("s"))
    return not held.groupBy("doc_id").agg(F.min("s").alias("a"), F.max("s").alias("b")).where("a != b").isEmpty()


class Shard:
    """The blocks of some terms in one shard, and their maxima over stretches of documents."""

    def __init__(self, terms: list[str], first: np.ndarray, top: np.ndarray, sizes: np.ndarray, nos: np.ndarray, shares: np.ndarray):
        """Blocks in order of term and first number; ``sizes`` postings each in ``nos`` and ``shares``."""
        self.nos, self.shares = nos, shares
        ends = np.concatenate(([0], np.cumsum(sizes)))
        self.stretches = int(nos.max()) // STRETCH + 1 if len(nos) else 0
        self.spans: dict[str, tuple[int, int]] = {}
        self.tops: dict[str, np.ndarray] = {}
        self.scored = 0
        cuts = [i for i in range(len(terms)) if i == 0 or terms[i] != terms[i - 1]] + [len(terms)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            bound = np.zeros(self.stretches)
            last = nos[ends[a + 1 : b + 1] - 1]
            for x, y, t in zip(first[a:b] // STRETCH, last // STRETCH, top[a:b], strict=True):
                np.maximum(bound[x : y + 1], t, out=bound[x : y + 1])
            self.spans[terms[a]], self.tops[terms[a]] = (int(ends[a]), int(ends[b])), bound

    def search(self, wanted: list[tuple[str, float]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and rounded scores of at least the ``k`` best documents, none with a score of 0."""
        wanted = [(t, w) for t, w in wanted if t in self.spans]
        bound = np.zeros(self.stretches)
        for term, weight in wanted:
            bound += weight * self.tops[term]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found_no, found_score, least, at, step = np.zeros(0, np.int64), np.zeros(0), 0.0, 0, 2
        while at < len(order) and bound[order[at]] >= least - MARGIN:
            for stretch in np.sort(order[at : at + step]):
                if bound[stretch] < least - MARGIN:
                    continue
                self.scored += 1
                low = int(stretch) * STRETCH
                total = np.zeros(STRETCH)
                for term, weight in wanted:
                    a, b = self.spans[term]
                    x, y = a + np.searchsorted(self.nos[a:b], [low, low + STRETCH])
                    total[self.nos[x:y] - low] += weight * self.shares[x:y]
                score = np.round(total, 10)
                own = np.flatnonzero((score > 0) & (score >= least))
                found_no, found_score = np.append(found_no, low + own), np.append(found_score, score[own])
                if len(found_score) > k:
                    least = np.partition(found_score, len(found_score) - k)[len(found_score) - k]
                    keep = found_score >= least
                    found_no, found_score = found_no[keep], found_score[keep]
            at, step = at + step, step * 2
        return found_no, found_score


def _shard_hits(queries: list[tuple], k: int):
    """Hits (query, shard, no, score) of the queries, a list of (number, [(term, weight)]), in the blocks of one shard."""

    def run(table: pa.Table) -> pa.Table:
        from_blocks = table.sort_by([("term", "ascending"), ("first", "ascending")]).combine_chunks()
        column = lambda name: pa.concat_arrays(from_blocks.column(name).chunks)
        nos, shares = column("nos"), column("shares")
        own = Shard(
            column("term").to_pylist(), column("first").to_numpy(), column("top").to_numpy(),
            np.diff(nos.offsets.to_numpy()), nos.flatten().to_numpy(), shares.flatten().to_numpy(),
        )
        out = [(number, *own.search(wanted, k)) for number, wanted in queries]
        sizes = [len(n) for _, n, _ in out]
        return pa.table(
            {
                "query": pa.array(np.repeat([q for q, _, _ in out], sizes), pa.int64()),
                "shard": pa.array(np.full(sum(sizes), table.column("shard")[0].as_py()), pa.int32()),
                "no": pa.array(np.concatenate([n for _, n, _ in out]), pa.int32()),
                "score": np.concatenate([s for _, _, s in out]),
            }
        )

    return run


def index_search(spark: SparkSession, folder: str, queries: DataFrame, k: int = 10, mode: str = "unicode", version: int | None = None) -> DataFrame:
    """The ``k`` best documents of every query text (query_id, text): (query_id, rank, id, score), as by ``tfidf_search``.

    Queries are taken in slices of about SLICE_TERMS terms, one reading of their blocks for each.
    """
    _, content = versions.read(spark, folder, version)
    place = f"{folder}/index/{content['name']}"
    numbers = spark.read.parquet(f"{place}/documents")
    listed = staged(queries.select("query_id", "text").withColumn("number", F.monotonically_increasing_id()), "queries")
    asked = staged(term_counts(listed.select(F.col("number").alias("doc_id"), "text"), mode), "asked")
    size = asked.agg(F.count("*")).first()[0]
    slices = max(1, -(-size // SLICE_TERMS))
    hits = None
    for i in range(slices):
        own = asked.where(F.pmod(F.xxhash64("doc_id"), F.lit(slices)) == i)
        terms = own.select("term").distinct()
        known = staged(spark.read.parquet(f"{place}/terms").join(F.broadcast(terms), "term", "left_semi"), "asked-terms")
        weighted = weigh_queries(own, TermModel(known, F.lit(content["documents"])))
        entries = _entries(weighted, "doc_id", F.lit(True)).collect()
        # At most about SLICE_TERMS entries.
        wanted = [(r["doc_id"], [(e["term"], e["weight"]) for e in r["entries"]]) for r in entries]
        buckets = [r[0] for r in known.select(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")).distinct().collect()]
        blocks = spark.read.parquet(f"{place}/blocks").where(F.col("bucket").isin(buckets))
        blocks = blocks.join(F.broadcast(known.select("term")), "term", "left_semi").select("shard", "term", "first", "top", "nos", "shares")
        found = blocks.groupBy("shard").applyInArrow(_shard_hits(wanted, k), "query long, shard int, no int, score double")
        hits = found if hits is None else hits.union(found)
    # The best k numbers need ids for their ties, so each shard's at least k are named before the last ranking.
    named = hits.join(numbers, ["shard", "no"]).select(F.col("query").alias("query_id"), F.col("doc_id").alias("id"), "score")
    best = best_hits(named, k).withColumnRenamed("query_id", "number")
    return best.join(listed.select("number", "query_id"), "number").select("query_id", "rank", "id", "score")

