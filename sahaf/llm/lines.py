"""Line deduplication by an exact set-similarity join of the lines' word shingles.

A line's tokens are its distinct shingles of five words (lower case; fewer words: the
whole line is one). Tokens are ordered by rarity, counted over all lines in a table of
fixed size, then by hash. Two lines of similarity ``percent`` share a token among the
first n - ceil(percent n) + 1 of each; lengths and the place of a shared token bound how
similar they can be. Lines that remain are compared by their whole sets. A line is
removed when an earlier line, of the same document or of one with a smaller id, is as
similar. Equal lines are one node with its first occurrence.

All of this is DataFrame functions, joins and groupings. The lines that occur most often
are listed once, so their copies don't fill a shuffle. Nulls: a null text stays null; a null
id comes last. Blank lines are kept. Rows with equal id and text are one document: each gets the same result.
Very long lines are compared whole. Lines of equal rank are ordered by their place. Other
columns are kept, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.frames import parts
from sahaf.llm.words import K
from sahaf.session import staged

PERCENT = 80
#: Counters of token frequency, as bits; bits of the table by which lines are passed over; rows of a task.
COUNTER_BITS, FILTER_BITS, TASK_ROWS = 16, 22, 1_000_000
#: Lines listed once, however often they occur.
OFTEN = 1 << 16
#: Blanks of a line other than the space.
BLANKS = "\t\x0b\x0c\r"


def document_key() -> Column:
    return F.xxhash64("doc_id", "text")


def lines_of(docs: DataFrame) -> DataFrame:
    """(z, doc_id, dkey, no, line, node) of each line that is not blank; z, doc_id, dkey, no give its place."""
    rows = docs.select(F.col("doc_id").isNull().alias("z"), "doc_id", document_key().alias("dkey"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    rows = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return rows.withColumn("node", F.xxhash64("line"))


def line_words(line: Column) -> Column:
    """The words of a line in lower case."""
    low = F.lower(line)
    odd = reduce(Column.__or__, [line.contains(x) for x in BLANKS])
    return F.array_remove(F.split(F.when(odd, F.translate(low, BLANKS, " " * len(BLANKS))).otherwise(low), " "), "")


def shingle(w: Column, i: Column) -> Column:
    """Hash of the shingle that begins at word ``i``."""
    return F.xxhash64(*[F.get(w, i + j) for j in range(K)])


def places(w: Column) -> Column:
    """Where the shingles of the words of a line begin."""
    return F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0)))


def rarity(lines: DataFrame) -> Column:
    """A constant array: for each counter, its place by how many tokens it counts.

    It has as many numbers as there are counters, whatever the input, and is sent as one text.
    """
    w = F.col("w")
    rows = lines.select(line_words(F.col("line")).alias("w")).select("w", F.explode(places(w)).alias("i"))
    counter = F.shiftrightunsigned(shingle(w, F.col("i")), 64 - COUNTER_BITS).cast("int")
    sums = rows.groupBy(counter.alias("counter")).agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    counts[sums.column("counter").to_numpy()] = sums.column("n").to_numpy()
    ranks = np.empty(len(counts), dtype=np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    return F.split(F.lit(",".join(map(str, ranks.tolist()))), ",").cast("array<bigint>")


def prefixes(lines: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """(token, node, n, at) of the prefixes of lines (node, line), each with n distinct tokens.

    A token is the rank of its counter, then the other bits of the hash; rarest come first.
    """
    w, t = F.col("w"), F.col("t")

    def token(h: Column) -> Column:
        rank = F.get(ranks, F.shiftrightunsigned(h, 64 - COUNTER_BITS).cast("int"))
        return F.shiftleft(rank, 63 - COUNTER_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << (63 - COUNTER_BITS)) - 1)))

    rows = lines.select("node", line_words(F.col("line")).alias("w"))
    made = F.transform(F.transform(places(w), lambda i: shingle(w, i)), token)
    rows = rows.select("node", F.sort_array(F.array_distinct(made)).alias("t"))
    short = F.size(t) - F.floor((F.size(t) * percent + 99) / 100).cast("int") + 1
    rows = rows.select("node", F.size(t).alias("n"), F.posexplode(F.slice(t, F.lit(1), short)).alias("at", "token"))
    return rows.select("token", "node", "n", "at")


def copied(firsts: DataFrame) -> DataFrame:
    """(node, first) of the lines that occur most often, at most OFTEN of them."""
    many = firsts.where("copies > 1")
    # Eighths of a power of two: some hundred rows, whatever the input.
    grade = F.floor(F.log2("copies") * 8)
    least, total = 0, 0
    for g, n in sorted(many.groupBy(grade.alias("g")).count().collect(), reverse=True):
        total += n
        if total > OFTEN:
            least = g + 1
            break
    return many.where(grade >= least).select("node", "first")


def may_match(n: Column, at: Column, m: Column, bt: Column, percent: int) -> Column:
    """Length and positional filter for sets of n and m that share tokens at places ``at`` and ``bt``."""
    rest = 1 + F.least(n - at, m - bt) - 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * rest >= percent * (n + m))


def verified(pairs: DataFrame, lines: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs (later, earlier) that are as similar, by their whole sets of tokens.

    Lines are tokenised again where a bit of a table of fixed size says they may be
    needed; of equal lines the first occurrence is used.
    """
    pairs = staged(pairs, "lines-pairs")
    needed = pairs.select(F.explode(F.array("later", "earlier")).alias("node")).distinct()
    needed = staged(needed.join(firsts, "node").select("node", "first"), "lines-needed")
    place = F.struct("z", "doc_id", "dkey", "no").alias("first")
    slot = F.pmod(F.xxhash64("node", "first"), F.lit(1 << FILTER_BITS))
    words = needed.groupBy(F.shiftright(slot, 5).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int"))).alias("w"))
    every = lines.sparkSession.range(1 << (FILTER_BITS - 5)).select(F.col("id").alias("i"))
    words = every.join(words, "i", "left").select("i", F.coalesce("w", F.lit(0)).alias("w"))
    table = staged(words.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda p: p["w"]).alias("bits")), "lines-bits")
    word = F.get(table.scalar(), F.shiftright(slot, 5).cast("int"))
    held = F.call_function("shiftright", word, slot.bitwiseAND(31).cast("int")).bitwiseAND(1) == 1
    rows = lines.select("node", place, "line").where(held).join(needed, ["node", "first"], "left_semi").dropDuplicates(["node"])
    w = F.col("w")
    made = F.array_distinct(F.transform(places(w), lambda i: shingle(w, i)))
    sets = staged(rows.select("node", line_words(F.col("line")).alias("w")).select("node", made.alias("tokens")), "lines-sets")
    both = pairs.join(sets.select(F.col("node").alias("later"), "tokens"), "later")
    both = both.join(sets.select(F.col("node").alias("earlier"), F.col("tokens").alias("others")), "earlier")
    inter = F.size(F.array_intersect("tokens", "others"))
    union = F.size("tokens") + F.size("others") - inter
    return both.where(100 * inter >= percent * union).select("later", "earlier")


def repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(dkey, nos): the numbers of the lines to remove from each document that has any."""
    spark = docs.sparkSession
    lines = lines_of(docs)
    place = F.struct("z", "doc_id", "dkey", "no")
    occurrences = staged(lines.select("z", "doc_id", "dkey", "no", "node"), "lines-all")
    counted = staged(occurrences.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("copies")), "lines-firsts")
    firsts = counted.select("node", "first")
    again = F.broadcast(copied(counted).select(F.col("node").alias("same"), "first"))
    listed = lines.join(again, (F.col("node") == F.col("same")) & (place != F.col("first")), "left_anti")
    postings = prefixes(listed.select("node", "line"), rarity(lines), percent)
    rows = occurrences.count() * 16
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts(rows, TASK_ROWS))
    same = Window.partitionBy("token")
    met = postings.repartition(tasks, "token").select("token", "node", "n", "at", F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high"))
    shared = met.where("low <> high").select("token", "node", "n", "at").distinct()
    shared = staged(shared.join(firsts, "node"), "lines-shared")

    # First, every line is held against the earliest of each token; most repeats end here.
    lead = shared.groupBy("token").agg(F.min(F.struct("first", "node", "n", "at")).alias("lead"))
    near = may_match(F.col("n"), F.col("at"), F.col("lead.n"), F.col("lead.at"), percent)
    pairs = shared.join(lead, "token").where((F.col("node") != F.col("lead.node")) & near)
    pairs = pairs.select(F.col("node").alias("later"), F.col("lead.node").alias("earlier")).distinct()
    found = verified(pairs, lines, firsts, percent)
    gone = staged(found.select(F.col("later").alias("node")).distinct(), "lines-gone")

    # The rest are held against every earlier line that they share a token with.
    x = shared.join(gone, "node", "left_anti").alias("x")
    y = shared.alias("y")
    near = may_match(F.col("x.n"), F.col("x.at"), F.col("y.n"), F.col("y.at"), percent)
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.first") < F.col("x.first")) & near)
    pairs = met.select(F.col("x.node").alias("later"), F.col("y.node").alias("earlier")).distinct()
    more = verified(pairs, lines, firsts, percent)
    gone = gone.union(more.select(F.col("later").alias("node")).distinct()).withColumn("gone", F.lit(True))

    status = firsts.join(gone, "node", "left")
    again = (place != F.col("first")) | F.coalesce("gone", F.lit(False))
    removed = occurrences.join(status, "node").where(again)
    return removed.groupBy("dkey").agg(F.collect_set("no").alias("nos"))


def without_repeats(docs: DataFrame, percent: int = PERCENT, removed: str | None = None) -> DataFrame:
    """The documents (doc_id, text, ..) without repeated lines; other columns stay as they are.

    ``n_chars``, where there is one, is that of the new text. ``removed`` names a column to
    add with the number of lines that a document lost.
    """
    nos = repeated_lines(docs.select("doc_id", "text"), percent)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(document_key().alias("dkey"), row).join(nos, "dkey", "left")
    kept = F.filter(F.split("row.text", "\n"), lambda x, i: ~F.array_contains("nos", i))
    out = joined.withColumn("text", F.when(F.col("nos").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")))
    own = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("nos").isNull(), own["n_chars"]).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    if removed:
        own[removed] = F.coalesce(F.size("nos"), F.lit(0)).cast("long")
    return out.select(*[v.alias(c) for c, v in own.items()])
