"""Mixing sources to target weights: exact budgets by distributed prefix sums.

DataFrame functions only. Nulls: a null text has size 0; a null source is a source of its
own and comes last. Ties and repeated rows: rows are ordered by a hash of their id, then
by id and size; rows equal in these are alike, so any order gives the same rows. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.frames import n_words, parts, running
from sahaf.session import staged

#: Rows of one source in one range of its order.
RANGE_ROWS = 20_000
LEAST_RANGES = 256


def source_key(source: Column) -> Column:
    """A text for each source that sorts by code point, null last, and is never null."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, weights: list[float], share: float, epochs: float) -> DataFrame:
    """(skey, source_size, target) from (skey, source_size), one row per source.

    The sources, in order, have the weights in turn and share ``share`` of all sizes. A
    target stops at ``epochs`` times its source's size, and what is over is shared again
    by weight: so each target is min(weight * level, limit) for one common level. With
    sources ordered by limit / weight, those whose ratio is under the level are full.
    """
    # One row per source, so windows over all of them are small.
    place = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    s = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(epochs))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "skey")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("budget", F.sum("source_size").over(every) * float(share))
    s = s.withColumn("full_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("budget") - F.col("full_before")) / open_weight)
    s = s.withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    # The level of the first source that is not full holds for all that follow.
    level = F.min(F.when(~F.col("full"), F.struct("full_before", "level"))).over(every)["level"]
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * level)
    return s.select("skey", "source_size", F.least(target, F.col("limit")).alias("target"))


def plan(
    docs: DataFrame, weights: list[float], share: float, epochs: float = 2.0, seed: int = 0, carry: list[str] | None = None
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of rows (doc_id, text, source).

    A source's budget is its target without the fraction. It is met exactly: every
    document is taken once for each whole epoch in the budget, and in the last, partial
    epoch the documents in hash order are taken until the words that are left run out;
    only the document at the cut gives part of its words. Columns named in ``carry`` move
    along with their rows.
    """
    key = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 1)
    sized = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("_key"),
        source_key(F.col("source")).alias("_skey"), *(carry or []),
    )
    if not carry:
        sized = staged(sized, "mix-sizes")
    sizes = sized.groupBy("_skey").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = staged(sizes, "mix-sources")
    most = sizes.agg(F.max("n")).first()[0] or 0
    aims = staged(targets(sizes.select(F.col("_skey").alias("skey"), "source_size"), weights, share, epochs), "mix-targets")
    ranges = parts(most, RANGE_ROWS, LEAST_RANGES)
    ranged = running(sized, "_skey", "_key", F.col("size"), ["doc_id", "size"], ranges, "_from")
    # One row per source: joined by its key, and split by Spark where one source has very many rows.
    joined = ranged.join(aims.withColumnRenamed("skey", "_skey"), "_skey")
    whole = F.floor(F.col("target"))
    times = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(F.lit(0))
    left = whole - times * F.col("source_size")
    part = F.least(F.greatest(left - F.col("_from"), F.lit(0)), F.col("size"))
    taken = (times * F.col("size") + part).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *(carry or []))


def mixed_texts(docs: DataFrame, weights: list[float], share: float, epochs: float = 2.0, seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them, with the columns that they had.

    The one at a cut also comes with its first words, one blank between them. ``n_chars``,
    where there is one, is that of the text given.
    """
    whole_row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    rows = docs.select("doc_id", "text", "source", whole_row)
    mix = plan(rows, weights, share, epochs, seed, ["_row"]).where("taken > 0").select("size", "taken", "_row")
    text = F.col("_row.text")
    copies = F.floor(F.col("taken").cast("double") / F.col("size")).cast("int")
    words = (F.col("taken") - copies * F.col("size")).cast("int")
    first = F.array_join(F.slice(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), F.lit(1), words), " ")
    pieces = F.array_repeat(text, copies)
    pieces = F.when(words > 0, F.concat(pieces, F.array(first))).otherwise(pieces)
    out = mix.select("_row", F.explode(pieces).alias("_text"))
    own = {c: F.col(f"_row.{c}") for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in own:
        own["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[v.alias(c) for c, v in own.items()])
