"""The prefix trie of conversations by truncation peeling.

Each conversation is one row with its path: for every depth the 128-bit hash of the
sequence up to there, and the words so far. Peeling begins at the greatest depth. At a
depth, the conversations that end there are merged with the nodes that survived from
below, by the sequence: each group is a node, found and aggregated at once. Then the last
turn is stripped from the survivors' paths, and they are grouped again one level up, down
to the root. A node is written once, with what its subtree added up to, so a conversation
is not copied into its prefixes. Where no conversation ends for some depths and no two
survivors meet there, their chains are written in one step: the number of steps is that of
the depths where something ends or meets, not the longest conversation.

Groups combine before the shuffle, so a hot first turn or a conversation with very many
copies reaches the shuffle as one row a task. The ids of the conversations that end at a
node are gathered in ranges of RANGE ids, each one text of bounded size; only the ranges'
texts meet, in order, to be hashed as one stream, since SHA-256 can't be divided. Texts
never move: a turn is shuffled as hashes and its number of words, once, by block.

Nulls: null roles and texts are empty, a null turn comes first; rows without conv_id
belong to no conversation. Empty texts are turns with no words; very long ones are hashed
whole. Turns of equal number go by their hash. Repeated rows are turns of their own. An
empty table has no root and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.frames import n_words
from sahaf.session import staged

#: Conversations of a block share the first turns of the block's first one; at most HEADS - 1 turns.
BLOCK, HEADS = 20, 4
#: Ids of one text of ended conversations, as bits.
RANGE = 16
EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, words) of the rebuilt turns; a conversation without any has one row of depth 0.

    A conversation has the first h turns of the first conversation of its block, and then
    its own turns after its first h, with h = crc32(conv_id) % HEADS. ``k1`` and ``k2`` are
    hashes of all turns up to this one, ``words`` counts their words.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"), "turn",
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), n_words(F.col("text")).alias("n"),
    )
    own = Window.partitionBy("block", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    # Placed by block once: windows and groups of a conversation lie inside.
    rows = rows.repartition("block").withColumn("no", F.row_number().over(own))
    turn = F.struct("a", "b", "n")
    of_block = Window.partitionBy("block")
    heads = [F.max(F.when((F.col("conv_id") == F.col("block")) & (F.col("no") == i), turn)).over(of_block) for i in range(1, HEADS)]
    rows = rows.withColumn("heads", F.array_compact(F.array(*heads)))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    taken = F.least(h, F.size("heads").cast("long"))
    # A conversation's first row brings the turns that it is given.
    first = F.slice("heads", F.lit(1), F.when(F.col("no") == 1, taken).otherwise(0).cast("int"))
    given = F.transform(first, lambda t, i: F.struct((i + 1).alias("depth"), t.alias("t")))
    at = (F.col("no") - h + taken).cast("int")
    later = F.filter(F.array(F.struct(at.alias("depth"), turn.alias("t"))), lambda x: F.col("no") > h)
    # Rows without a turn stay, at depth 0, for conversations that have none.
    rows = rows.select("block", "conv_id", F.explode_outer(F.concat(given, later)).alias("x"))
    rows = rows.select("block", "conv_id", F.col("x.depth").alias("depth"), "x.t.*")
    upto = Window.partitionBy("block", "conv_id").orderBy(F.col("depth").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    hashed = [F.when(F.col("depth").isNotNull(), F.xxhash64(F.lit(s), "depth", "a", "b")) for s in (2, 3)]
    rows = rows.select(
        "block", "conv_id", F.coalesce("depth", F.lit(0)).alias("depth"),
        *[F.coalesce(F.bit_xor(x).over(upto), F.lit(0)).alias(k) for k, x in zip(("k1", "k2"), hashed, strict=True)],
        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("words"),
    )
    return rows


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, path) of each conversation; path has (k1, k2, words) of every depth from 1."""
    step = F.when(F.col("depth") > 0, F.struct("depth", "k1", "k2", "words"))
    rows = rebuilt(turns).groupBy("block", "conv_id").agg(F.max("depth").alias("depth"), F.sort_array(F.collect_list(step)).alias("path"))
    path = F.transform("path", lambda s: F.struct(s["k1"].alias("k1"), s["k2"].alias("k2"), s["words"].alias("words")))
    return rows.select("conv_id", "depth", path.alias("path"))


def last(path: str, field: str, back: int = 1) -> Column:
    """A field of the last step of a path, or of an earlier one; 0 at the root."""
    return F.coalesce(F.get(F.col(path), F.size(path) - back)[field], F.lit(0).cast("long"))


def ends(convs: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the sequences at which conversations end, from (conv_id, k1, k2, depth)."""
    ranged = convs.groupBy("k1", "k2", "depth", F.shiftright("conv_id", RANGE).alias("range"))
    # At most 2^RANGE different ids in a range.
    ids = F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")), lambda c: c.cast("string")), ",")
    texts = ranged.agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = row[:3], hashlib.sha256(row[4].encode())
                else:
                    state.update(b"," + row[4].encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
                out = []
        if key is not None:
            out.append((*key, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    names = ["k1", "k2", "depth", "ends_sha256"]
    rows = texts.repartition("k1", "k2", "depth").sortWithinPartitions("k1", "k2", "depth", "range")
    return rows.select("k1", "k2", F.col("depth").cast("long"), "range", "ids").mapInArrow(run, "k1 long, k2 long, depth long, ends_sha256 string")


def regrouped(rows: DataFrame) -> DataFrame:
    """Nodes of one depth from rows (path, conv_id, n_convs, n_children, n_leaves, saved_tokens).

    A survivor from below brings n_children = 1 and its subtree's sums, an ended
    conversation zeros.
    """
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = rows.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *sums)
    own = last("path", "words") - last("path", "words", 2)
    return nodes.select(
        "path", "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * own).alias("saved_tokens"),
    )


def meeting(nodes: DataFrame, above: int, below: int) -> int:
    """The greatest depth between the two at which two of the nodes have one ancestor; ``above`` if there is none."""
    steps = nodes.select(F.posexplode(F.slice("path", above + 1, below - above - 1)).alias("i", "s"))
    shared = steps.groupBy("i", "s.k1", "s.k2").count().where("count > 1")
    found = shared.agg(F.max("i")).first()[0]
    return above if found is None else above + 1 + found


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of all conversations of (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256), numbers as long.
    """
    convs = staged(paths(turns), "trie-paths")
    zero = F.lit(0).cast("long")
    ended = convs.groupBy("path", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    # Sorted, so that a depth is read from few row groups.
    ended = staged(ended.sortWithinPartitions("depth"), "trie-ended")
    depths = sorted((r[0] for r in ended.select("depth").distinct().collect()), reverse=True) or [0]
    levels, survivors, depth = [], None, depths[0]
    while True:
        new = ended.where(F.col("depth") == depth)
        rows = new.select("path", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
        nodes = regrouped(rows if survivors is None else rows.union(survivors))
        nodes = staged(nodes, "trie-level")
        levels.append(_keyed(nodes))
        if depth == 0:
            break
        after = next((d for d in depths if d < depth), 0)
        if depth - after > 1:
            after = meeting(nodes, after, depth)
        if depth - after > 1:
            levels.append(_chains(nodes, after, depth))
        # Between two steps a survivor is the only child of its ancestors, which save as often as it does.
        chain = (F.col("n_convs") - 1) * (last("path", "words", 2) - _words_at(after))
        survivors = nodes.select(
            F.slice("path", 1, after).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
            (F.col("saved_tokens") + chain).alias("saved_tokens"),
        )
        depth = after
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    root = nodes.agg(F.min("conv_id")).first()[0]
    return _named(every, root, ends(_ended_keys(convs)))


def _words_at(depth: int) -> Column:
    return F.coalesce(F.get("path", F.lit(depth - 1))["words"], F.lit(0).cast("long")) if depth else F.lit(0).cast("long")


def _keyed(nodes: DataFrame) -> DataFrame:
    """Nodes with their own and their parent's hash instead of the path."""
    keys = [last("path", "k1").alias("k1"), last("path", "k2").alias("k2"), last("path", "k1", 2).alias("p1"), last("path", "k2", 2).alias("p2")]
    return nodes.select("conv_id", F.size("path").alias("depth"), "n_convs", "n_children", "n_leaves", "saved_tokens", *keys)


def _chains(nodes: DataFrame, above: int, below: int) -> DataFrame:
    """The nodes strictly between two depths, each the only child of the one before."""
    rows = nodes.select("*", F.explode(F.sequence(F.lit(above + 1), F.lit(below - 1))).alias("depth"))
    step = [F.get("path", F.col("depth") - i) for i in (1, 2)]
    earlier = F.coalesce(step[1]["words"], F.lit(0).cast("long"))
    return rows.select(
        "conv_id", "depth", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * (last("path", "words", 2) - earlier)).alias("saved_tokens"),
        step[0]["k1"].alias("k1"), step[0]["k2"].alias("k2"),
        F.coalesce(step[1]["k1"], F.lit(0).cast("long")).alias("p1"), F.coalesce(step[1]["k2"], F.lit(0).cast("long")).alias("p2"),
    )


def _ended_keys(convs: DataFrame) -> DataFrame:
    return convs.select("conv_id", last("path", "k1").alias("k1"), last("path", "k2").alias("k2"), "depth")


def _named(nodes: DataFrame, root: int | None, sha: DataFrame) -> DataFrame:
    """The nodes with the smallest member of the parent and the hash of the ids that end there.

    Nodes of depth 1 have the root as parent, however many they are. Another parent with
    very many children is split by the adaptive skew join.
    """
    parents = nodes.select(F.col("conv_id").alias("parent"), F.col("depth").alias("_d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    parents = parents.where("_d > 0").withColumn("_d", F.col("_d") + 1)
    deep = nodes.where("depth > 1").withColumnRenamed("depth", "_d").join(parents.hint("merge"), ["_d", "p1", "p2"])
    deep = deep.select("conv_id", F.col("_d").alias("depth"), "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "k1", "k2")
    above = F.when(F.col("depth") == 1, F.lit(root).cast("long")).alias("parent")
    rows = deep.union(nodes.where("depth < 2").select("conv_id", "depth", above, "n_convs", "n_children", "n_leaves", "saved_tokens", "k1", "k2"))
    rows = rows.withColumn("depth", F.col("depth").cast("long")).join(sha, ["k1", "k2", "depth"], "left")
    return rows.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
