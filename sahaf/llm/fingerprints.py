"""Bottom-k sketches of word shingles: mergeable fingerprints of documents.

DataFrame functions only. A sketch is the sorted array of the k smallest 48-bit hashes of
the distinct shingles of five words (A to Z lowered; fewer words: the whole sequence as
one shingle; no words: an empty sketch). Sketches of parts merge to the sketch of the
whole set of shingles.

Nulls: a null text is empty. Repeated rows get a row each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.frames import parts

K, WORDS = 128, 5
HASH_BITS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"
#: Documents of one range of ids.
RANGE_ROWS = 2_000
MOST_RANGES = 4_096


def words(text: Column) -> Column:
    """Array of the words of a text. An empty one stands in front of or behind outer blanks; it is removed."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPACES), "")


def sketch(text: Column, k: int = K, n: int = WORDS) -> Column:
    """Bottom-k sketch of a text."""
    return sketch_of_words(words(text), k, n)


def sketch_of_words(w: Column, k: int = K, n: int = WORDS) -> Column:
    def hashes(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        own = F.transform(at, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, n)), 64 - HASH_BITS))
        return F.when(F.size(w) > 0, own).otherwise(F.array().cast("array<long>"))

    # The array of words is made once: a lambda's argument is evaluated before its body.
    made = F.transform(F.array(w), hashes)[0]
    return bottom(made, k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return bottom(F.concat(a, b), k)


def merged(df: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """(keys.., sketch): sketches of the parts of each key merged.

    Each task keeps the k smallest hashes that it has of a key before they meet.
    """
    rows = df.select(*keys, F.explode_outer(sketch).alias("_h")).distinct()
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_h").asc_nulls_last())))
    small = ranked.where(F.col("_rank") <= k)
    return small.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of both sets in the sketch of their union. Two empty sets are alike."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / the k-th hash as a fraction."""
    kth = F.element_at(s, k).cast("double") / float(1 << HASH_BITS)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    inter = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), inter / distinct_count(a, k)))


def as_text(s: Column) -> Column:
    """A sketch as lower-case hexadecimal digits, twelve for each hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def with_next(docs: DataFrame, columns: list[str], order: str = "doc_id", tie: str = "text") -> DataFrame:
    """Adds ``next_<column>`` of the next row by ``order`` (nulls first, then by ``tie``); the last row's is the first.

    The ids are cut into ranges at ids that occur. Each row moves once, to its range, and
    the rows that a range begins with also go to the range before, to be their last row's
    next. Only the cuts, a bounded number, are known to the driver.
    """
    stats = docs.agg(F.count("*"), F.min(order)).first()
    if stats[0] == 0 or stats[1] is None:
        cuts = [] if stats[1] is None else [stats[1]]
    else:
        n = min(MOST_RANGES, parts(stats[0], RANGE_ROWS))
        shares = [(i + 1) / n for i in range(n - 1)]
        found = docs.agg(F.percentile_approx(order, shares or [0.5], 100 * n)).first()[0] if n > 1 else []
        cuts = sorted({stats[1], *found})
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    total = len(cuts) + 1
    own = F.when(F.col(order).isNull(), 0).otherwise(F.size(F.filter(edges, lambda c: c <= F.col(order))))
    # Range 0 holds null ids only, and may be empty: then range 1 begins the order.
    nulls = docs.where(F.col(order).isNull()).limit(1).count() > 0
    before = F.pmod(F.col("_own") - 1, F.lit(total)) if nulls else F.pmod(F.col("_own") - 2, F.lit(total - 1)) + 1
    begins = F.array_contains(edges, F.col(order)) if cuts else F.lit(False)
    head = F.when(F.col(order).isNull(), F.lit(nulls)).otherwise(begins)
    there = F.when(head, F.array(F.struct(F.col("_own").alias("r"), F.lit(False).alias("ghost")),
                                 F.struct(before.cast("int").alias("r"), F.lit(True).alias("ghost"))))
    there = there.otherwise(F.array(F.struct(F.col("_own").alias("r"), F.lit(False).alias("ghost"))))
    rows = docs.withColumn("_own", own.cast("int")).withColumn("_there", F.explode(there))
    rows = rows.withColumn("_range", F.col("_there.r")).withColumn("_ghost", F.col("_there.ghost")).drop("_own", "_there")
    place = Window.partitionBy("_range").orderBy("_ghost", F.col(order).asc_nulls_first(), tie)
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(place))
    return rows.where("not _ghost").drop("_range", "_ghost")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of texts (doc_id, text), of their edited texts, and how alike they are.

    The edited text has its last quarter replaced by the beginning of the next document.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = base.withColumn("sketch", sketch(F.col("text"), k))
    rows = with_next(own, ["text", "sketch"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("shingles"),
    )
