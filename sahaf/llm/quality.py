"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

The model is trained, per language, on the share SHARE of all trusted documents, so its
counts grow with them; counts, continuation counts, discounts and back-off weights are
Spark aggregations. The log probability of a text is written as a sum over its n-grams:
the language's floor for each word, and for each n-gram of the model what it adds to what
the shorter ones give. So n-grams are looked up one by one: the FREQUENT entries that were
counted most are sent to the tasks, all others are joined in Spark with the n-grams
(document, key, count) of the documents, and summed by document. Before that join, a
table of bits of fixed size drops n-grams that are in no entry; it only saves rows.
Values are multiples of 2^-30, so that sums don't depend on their order.

All of this is done for one of SLICES parts after another, so that what is shuffled and
written for a part is gone before the next. A part has the trigrams with a middle word of
its own: their contexts, the pairs that they end in and the contexts of these are whole
there. Only counts of words, and how many entries have which count, go over all parts.
Kept between the parts are the trigram and pair counts and a sum of each text.

A document is kept when its perplexity is at most a quantile of its language, taken over
the trusted documents that were not trained on. There is no lower limit: documents that
were trained on, and their copies, have the lowest perplexities.

Words are runs of bytes other than blanks, with A to Z lowered. Nulls: a null text, like
one without words, has no perplexity and is kept; a null language is a language of its
own. A language without trusted documents has no limits: its documents are kept. Repeated
rows get a row each. Very long texts are scored whole. Entries that were counted equally
often are sent or joined together, which changes no score. An empty table gives no rows.
Columns of the names that are added are replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sahaf.llm.words import blocks, mixed, span_hashes, words
from sahaf.session import STAGED, drop, release, staged

#: Share of the trusted documents that are trained on; the others give the limits.
SHARE = 0.5
#: Quantile of the trusted perplexities up to which a document is kept.
HIGH = 0.99
#: Parts that are counted, weighed and joined one after another.
SLICES = 6
#: Entries of a shard; entries of a part that are sent to the tasks; bits of the table before the join.
SHARD, FREQUENT, FILTER_BITS = 1 << 20, 1 << 20, 27
#: Values are multiples of 1 / UNIT.
UNIT = float(1 << 30)
#: Discounts where the counts of counts don't give any.
DISCOUNTS = (0.5, 0.75, 0.9)

_START = np.array([0x5BD1E995A1B2C3D5, 0x27D4EB2F165667C5], dtype=np.uint64)


def lang_hash(langs: pa.Array) -> np.ndarray:
    """A number for each row's language; null is one too."""
    coded = langs.dictionary_encode()
    values = [("-" if v is None else f"+{v}").encode() for v in [*coded.dictionary.to_pylist(), None]]
    own = np.array([int(span_hashes(np.frombuffer(v, np.uint8), np.array([0]), np.array([len(v)]))[0]) for v in values], np.uint64)
    at = coded.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False)
    return own[at]


def hashed(*columns: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of long columns."""
    one, two, three, four, five = (np.uint64(x) for x in _XX)
    out = np.full(len(columns[0]), 42, dtype=np.uint64)
    for c in columns:
        k = c * two
        out = (out + five + np.uint64(8)) ^ ((k << np.uint64(31) | k >> np.uint64(33)) * one)
        out = (out << np.uint64(27) | out >> np.uint64(37)) * one + four
        out = (out ^ (out >> np.uint64(33))) * two
        out = (out ^ (out >> np.uint64(29))) * three
        out ^= out >> np.uint64(32)
    return out


#: The primes of xxHash.
_XX = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def places(texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every word w and the words v and u before it, as numbers that differ by language; and words per text.

    Each text begins with two signs of its beginning, so each word has a full context.
    """
    h, at = words(texts)
    n = np.diff(at)
    own = lang_hash(langs)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) + 2 * (doc + 1)
    padded = np.empty(len(h) + 2 * len(n), dtype=np.uint64)
    begin = at[:-1] + 2 * np.arange(len(n))
    padded[begin], padded[begin + 1] = _START[0], _START[1]
    padded[place] = h
    padded = mixed(padded ^ np.repeat(own, n + 2))
    return padded[place - 2], padded[place - 1], padded[place], n


def grams(texts: pa.Array, langs: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Keys of every word and its contexts: w, v, vw, uv, uvw; and words per text."""
    u, v, w, n = places(texts, langs)
    uv = hashed(u, v)
    return {"w": w, "v": v, "vw": hashed(v, w), "uv": uv, "uvw": hashed(uv, w)}, n


def part_of(h: np.ndarray) -> np.ndarray:
    """The part of each word's number."""
    return (h >> np.uint64(32)) % np.uint64(SLICES)


def training_rows(part: int):
    """Rows (lang, u, v, w) of texts (text, lang) with v of the part; lang as its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                langs = batch.column(1).slice(a, b - a)
                u, v, w, n = places(batch.column(0).slice(a, b - a), langs)
                own = part_of(v) == part
                lang = np.repeat(lang_hash(langs), n)
                columns = [pa.array(x[own].view(np.int64)) for x in (lang, u, v, w)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "u", "v", "w"])

    return run


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): what is taken from counts of one, two, and more, from rows (lang, .., c).

    That depends on how many entries of the language have counts 1 to 4.
    """
    n = counts.groupBy("lang").agg(*[F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    fine = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    ds = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        ds.append(F.coalesce(F.when(fine & (d > 0) & (d < k), d), F.lit(DISCOUNTS[k - 1])).alias(f"d{k}"))
    # One row per language: staged, so that Spark knows its size before it plans the join.
    return staged(n.select("lang", *ds), "quality-discounts")


def sums() -> dict[str, Column]:
    """Of the entries of a context: the total of their counts, and how many have a count of one, two, and more."""
    many = {"k1": F.col("c") == 1, "k2": F.col("c") == 2, "k3": F.col("c") > 2}
    return {"total": F.sum("c"), **{k: F.sum(F.when(x, 1).otherwise(0)) for k, x in many.items()}}


def share() -> Column:
    """What an entry has of its context's total, after the discount."""
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    return (F.col("c") - d) / F.col("total")


def weight() -> Column:
    """What the discounts of a context leave to the next lower order."""
    return (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total")


def counted(texts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame, list[str]]:
    """Counts of trigrams (lang, u, v, w, c) and pairs (lang, v, w, c) by part, of words (lang, w, c), and the tables' names.

    The parts' tables are named in the order trigrams, pairs of each part.
    """
    rows = staged(texts.select("text", "lang"), "quality-texts")
    own = STAGED[-1]
    threes, twos, names = [], [], []
    for part in range(SLICES):
        some = rows.mapInArrow(training_rows(part), "lang long, u long, v long, w long")
        # Words recur, so a dictionary of them takes a third of the space.
        threes.append(staged(some.groupBy("lang", "u", "v", "w").agg(F.count("*").alias("c")), "quality-trigrams", **WORDS))
        names.append(STAGED[-1])
        twos.append(staged(threes[-1].groupBy("lang", "v", "w").agg(F.count("*").alias("c")), "quality-pairs", **WORDS))
        names.append(STAGED[-1])
    drop(rows.sparkSession, [own])
    one = staged(reduce(DataFrame.union, twos).groupBy("lang", "w").agg(F.count("*").alias("c")), "quality-words")
    return threes, twos, one, names


#: A Parquet dictionary of a million words.
WORDS = {"parquet.dictionary.page.size": str(8 << 20)}


def word_shares(one: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, floor), the probability of any unseen word, and (lang, w, c, a), from counts of words."""
    ds = discounts(one)
    langs = one.groupBy("lang").agg(*[x.alias(k) for k, x in sums().items()])
    langs = staged(langs.join(ds, "lang").withColumn("floor", weight() / (F.col("k1") + F.col("k2") + F.col("k3") + 1)), "quality-floors")
    return langs.select("lang", "floor"), one.join(langs.drop("k1", "k2", "k3"), "lang").select("lang", "w", "c", share().alias("a"), "floor")


def pair_contexts(two: DataFrame, ds: DataFrame) -> DataFrame:
    """(lang, v, total, g) and the discounts, from counts of pairs."""
    contexts = two.groupBy("lang", "v").agg(*[x.alias(k) for k, x in sums().items()]).join(ds, "lang")
    return contexts.withColumn("g", weight()).drop("k1", "k2", "k3")


def pair_shares(two: DataFrame, ds: DataFrame) -> DataFrame:
    """(v, w, c, a, g) from counts of pairs."""
    return two.join(pair_contexts(two, ds), ["lang", "v"]).select("v", "w", "c", share().alias("a"), "g")


def trigram_sums(three: DataFrame) -> DataFrame:
    """Adds the sums of its context to each count of a trigram, and whether it is the context's first."""
    same = Window.partitionBy("lang", "u", "v")
    return three.select("*", *[x.over(same).alias(k) for k, x in sums().items()], (F.min("w").over(same) == F.col("w")).alias("first"))


def train(texts: DataFrame) -> DataFrame:
    """The model as (kind, key, value) from texts (text, lang).

    Kinds: 3 and 2 and 1 entries by uvw, vw, w; 13 and 12 back-off weights by uv, v; 0 the
    probability of any unseen word, by language.
    """
    threes, twos, one, _ = counted(texts)
    three, two = reduce(DataFrame.union, threes), reduce(DataFrame.union, twos)
    ds3, ds2 = discounts(three), discounts(two)
    floors, p1 = word_shares(one)
    e3 = trigram_sums(three).join(ds3, "lang").select("*", share().alias("a"), weight().alias("g"))

    def table(df: DataFrame, kind: int, key: Column, value: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), key.alias("key"), F.col(value).cast("double").alias("value"))

    uv = F.xxhash64("u", "v")
    model = table(e3, 3, F.xxhash64(uv, "w"), "a").union(table(e3.where("first"), 13, uv, "g"))
    model = model.union(table(pair_shares(two, ds2), 2, F.xxhash64("v", "w"), "a"))
    model = model.union(table(pair_contexts(two, ds2), 12, F.col("v"), "g"))
    return staged(model.union(table(p1, 1, F.col("w"), "a")).union(table(floors, 0, F.col("lang"), "floor")), "quality-model")


def summands(texts: DataFrame) -> tuple[Iterator[DataFrame], DataFrame]:
    """The model's parts in turn, each as (key, value, weight), and the languages' floors (lang, floor), from texts (text, lang).

    A text's log probability is the sum, over its words, of the floor of its language and of
    the values of five keys: w, vw, uvw, and the complements of v and uv, which are back-off
    weights; a key without entry adds nothing. Entries of w and v are in the part of that word,
    all others in that of the trigram's middle word. ``weight`` is about how often a key was
    counted. A part is deleted when the next is asked for.
    """
    spark = texts.sparkSession
    threes, twos, one, names = counted(texts)
    ds3, ds2 = discounts(reduce(DataFrame.union, threes)), discounts(reduce(DataFrame.union, twos))
    floors, p1 = word_shares(one)
    p1 = staged(p1.select("w", "c", "floor", (F.col("a") + F.col("floor")).alias("p1")), "quality-words")

    def rows(df: DataFrame, key: Column, value: Column, weight: str) -> DataFrame:
        return df.select(key.alias("key"), (F.round(F.log(value) * UNIT) / UNIT).alias("value"), F.col(weight).cast("long").alias("weight"))

    def parts() -> Iterator[DataFrame]:
        for part in range(SLICES):
            p2 = pair_shares(twos[part], ds2).join(p1.select("w", "p1"), "w").withColumn("p2", F.col("a") + F.col("g") * F.col("p1"))
            ratio = F.col("p2") / (F.col("g") * F.col("p1"))
            p2 = staged(p2.select("v", "w", "c", "p2", ratio.alias("ratio")), "quality-pairs", **WORDS)
            used = [STAGED[-1], *names[2 * part : 2 * part + 2]]
            p3 = trigram_sums(threes[part]).join(p2.select("v", "w", "p2"), ["v", "w"]).join(ds3, "lang").withColumn("g", weight())
            p3 = p3.withColumn("p3", share() + F.col("g") * F.col("p2"))
            uv = F.xxhash64("u", "v")
            entry = F.struct(F.xxhash64(uv, "w").alias("key"), (F.col("p3") / (F.col("g") * F.col("p2"))).alias("value"), F.col("c").alias("weight"))
            context = F.struct(F.bitwise_not(uv).alias("key"), F.col("g").alias("value"), F.col("total").alias("weight"))
            p3 = p3.select(F.inline(F.when(F.col("first"), F.array(entry, context)).otherwise(F.array(entry))))
            model = rows(p3, F.col("key"), F.col("value"), "weight")
            model = model.union(rows(p2, F.xxhash64("v", "w"), F.col("ratio"), "c"))
            model = model.union(rows(pair_contexts(twos[part], ds2), F.bitwise_not("v"), F.col("g"), "total"))
            own = p1.where(F.shiftrightunsigned("w", 32) % SLICES == part)
            model = staged(model.union(rows(own, F.col("w"), F.col("p1") / F.col("floor"), "c")), "quality-model")
            name = STAGED[-1]
            drop(spark, used)
            yield model
            drop(spark, [name])

    return parts(), staged(floors.select("lang", F.log("floor").alias("floor")), "quality-floors")


Shard = tuple[np.ndarray, np.ndarray, np.ndarray]


def shard(keys: np.ndarray, values: np.ndarray) -> Shard:
    """Sorted keys, their values, and where each range of equal leading bits begins."""
    bits = max(1, len(keys).bit_length())
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return keys, values, np.searchsorted(keys, firsts).astype(np.int32)


def sharded(model: DataFrame) -> dict[int, list[Shard]]:
    """Each kind's entries as shards by rising ranges of the key, on the driver: for a model of few texts."""
    rows = model.toArrow()
    kind, key = rows.column(0).to_numpy(), rows.column(1).to_numpy().view(np.uint64)
    value = rows.column(2).to_numpy()
    out = {}
    for k in (0, 1, 2, 3, 12, 13):
        own = np.flatnonzero(kind == k)
        own = own[np.argsort(key[own])]
        cuts = range(0, len(own), SHARD)
        out[k] = [shard(key[own[i : i + SHARD]], value[own[i : i + SHARD]]) for i in cuts]
    return out


def join_counts(shards: list[Shard], keys: np.ndarray, missing: float, among: np.ndarray | None = None) -> np.ndarray:
    """The value of each key, or of those at ``among``: a join with one shard after another.

    A key's place is sought from the beginning of its range of leading bits; a range has
    about one key.
    """
    out = np.full(len(keys), missing)
    asked = np.arange(len(keys)) if among is None else among
    for own, values, begin in shards:
        at = begin[(keys[asked] >> np.uint64(64 - (len(begin).bit_length() - 1))).astype(np.int64)].astype(np.int64)
        left = asked
        while len(left):
            inside = at < len(own)
            left, at = left[inside], at[inside]
            there, sought = own[at], keys[left]
            hit = there == sought
            out[left[hit]] = values[at[hit]]
            before = there < sought
            left, at = left[before], at[before] + 1
    return out


def log_probability(shards, texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the natural log probabilities of each text's words, and the number of words.

    NaN where the language has no model.
    """
    keys, n = grams(texts, langs)
    floor = np.repeat(join_counts(shards[0], lang_hash(langs), np.nan), n)
    one = join_counts(shards[1], keys["w"], 0.0)
    # A word pair can only be known where its first word is known as a context, and so on.
    back1 = join_counts(shards[12], keys["v"], np.nan)
    some = np.flatnonzero(~np.isnan(back1))
    two = join_counts(shards[2], keys["vw"], 0.0, some)
    back2 = join_counts(shards[13], keys["uv"], np.nan, some)
    some = np.flatnonzero(~np.isnan(back2))
    three = join_counts(shards[3], keys["uvw"], 0.0, some)
    back1[np.isnan(back1)] = back2[np.isnan(back2)] = 1.0
    p = three + back2 * (two + back1 * (one + floor))
    sums = np.concatenate(([0.0], np.cumsum(np.log(p))))
    to = np.concatenate(([0], np.cumsum(n)))
    total = sums[to[1:]] - sums[to[:-1]]
    if np.isnan(total).any():
        total = np.array([np.log(p[a:b]).sum() if b > a else 0.0 for a, b in zip(to[:-1], to[1:], strict=True)])
    return total, n


def sendable(model: DataFrame) -> tuple[Shard, np.ndarray, np.ndarray, DataFrame]:
    """At most FREQUENT entries of the model as a shard of places, their values, the bits, and the other entries.

    The bits are set for the leading FILTER_BITS bits of the keys of the other entries.
    """
    # Eighths of a power of two: some hundred rows, whatever the input.
    grade = F.floor(F.log2("weight") * 8)
    least, total = 0, 0
    for g, n in sorted(model.groupBy(grade.alias("g")).count().collect(), reverse=True):
        total += n
        if total > FREQUENT:
            least = g + 1
            break
    rows = model.where(grade >= least).select("key", "value").toArrow()
    key = rows.column(0).to_numpy().view(np.uint64)
    order = np.argsort(key)
    rest = model.where(grade < least).select("key", "value")
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    found = rest.groupBy(F.shiftright(slot, 6).alias("i")).agg(F.bit_or(one).alias("w")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return shard(key[order], np.arange(len(order), dtype=np.float64)), rows.column(1).to_numpy()[order], bits, rest


def asked_rows(sent: Broadcast, part: int):
    """Rows (dkey, key, n, near, words, lang) of (text, lang, dkey): how often a text asks for a key of the part that was not sent.

    Each text has one more row that asks for nothing, with what sent entries add (near), its
    words and the number of its language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, values, bits = sent.value
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                own = batch.slice(a, b - a)
                u, v, w, n = places(own.column(0), own.column(1))
                doc = np.repeat(np.arange(len(n)), n)
                last, here = np.flatnonzero(part_of(w) == part), np.flatnonzero(part_of(v) == part)
                u, v, end = u[here], v[here], w[here]
                uv = hashed(u, v)
                key = np.concatenate((w[last], ~v, hashed(v, end), ~uv, hashed(uv, end)))
                doc = np.concatenate((doc[last], *[doc[here]] * 4))
                at = join_counts([frequent], key, -1.0).astype(np.int64)
                hit = at >= 0
                near = np.bincount(doc[hit], values[at[hit]], len(n))
                doc, key = doc[~hit], key[~hit]
                slot = key >> np.uint64(64 - FILTER_BITS)
                maybe = ((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
                doc, key = doc[maybe], key[maybe]
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))[: len(doc)])
                count = np.diff(np.append(first, len(key))).astype(np.int32)
                none, dkey = len(first), own.column(2)
                columns = [
                    pa.concat_arrays([dkey.take(pa.array(doc[first])), dkey]),
                    pa.concat_arrays([pa.array(key[first].view(np.int64)), dkey]),
                    pa.array(np.append(count, np.zeros(len(n), np.int32))),
                    pa.array(np.append(np.zeros(none), near)),
                    pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(n)]),
                    pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(lang_hash(own.column(1)).view(np.int64))]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["dkey", "key", "n", "near", "words", "lang"])

    return run


def text_key() -> Column:
    """A number of the text and its language; null differs from all others."""
    return F.xxhash64(F.isnull("lang"), "lang", F.isnull("text"), "text")


def scored(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(dkey, n_words, perplexity) of each text_key of the documents, under the model of ``texts``.

    The perplexity is null for a text without words or a language without model.
    """
    spark, before = docs.sparkSession, len(STAGED)
    models, floors = summands(texts)
    rows = docs.select("text", "lang", text_key().alias("dkey"))
    added = []
    for part, model in enumerate(models):
        *most, rest = sendable(model)
        sent = spark.sparkContext.broadcast(tuple(most))
        asked = rows.mapInArrow(asked_rows(sent, part), "dkey long, key long, n int, near double, words long, lang long")
        got = asked.join(rest, "key", "left").withColumn("value", F.col("near") + F.coalesce(F.col("n") * F.col("value"), F.lit(0.0)))
        each = got.groupBy("dkey").agg(F.sum("value").alias("value"), F.count("words").alias("copies"), F.max("words").alias("words"), F.max("lang").alias("lang"))
        added.append(staged(each, "quality-added"))
        sent.destroy()
    each = reduce(DataFrame.union, added).groupBy("dkey").agg(F.sum("value").alias("value"), *[F.max(c).alias(c) for c in ("copies", "words", "lang")])
    each = each.join(floors, "lang", "left")
    # Copies ask for the same, so their sum is shared among them.
    perplexity = F.when(F.col("words") > 0, F.exp(-F.col("floor") - F.col("value") / F.col("copies") / F.col("words")))
    scores = staged(each.select("dkey", F.col("words").alias("n_words"), perplexity.alias("perplexity")), "quality-scores")
    release(spark, since=before, last=1)
    return scores


def classify(docs: DataFrame, trusted: DataFrame, high: float = HIGH) -> DataFrame:
    """Adds n_words, perplexity, limit and keep to documents (doc_id, text, lang, ..).

    ``trusted`` has the ids (doc_id) of trusted documents. Only texts that may be trained on
    are moved, to meet the ids.
    """
    ids = staged(trusted.where("doc_id IS NOT NULL").select("doc_id").distinct(), "quality-trusted")
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53) < SHARE
    texts = docs.select("doc_id", "text", "lang").where(drawn).join(ids.where(drawn), "doc_id", "left_semi")
    scores = scored(docs, texts)
    lang = F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("-")).alias("_lang")
    base = docs.where(~drawn).select("doc_id", lang, text_key().alias("dkey"))
    rest = base.join(ids.where(~drawn), "doc_id", "left_semi").select("_lang", "dkey").join(scores, "dkey")
    limits = rest.groupBy("_lang").agg(F.percentile_approx("perplexity", high, 100_000).alias("limit"))
    limits = staged(limits, "quality-limits")
    kept = [c for c in docs.columns if c not in ("n_words", "perplexity", "limit", "keep")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    out = docs.select(row, text_key().alias("dkey"), lang).join(scores, "dkey").join(limits, "_lang", "left")
    keep = ~F.coalesce(F.col("perplexity") > F.col("limit"), F.lit(False))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "n_words", "perplexity", "limit", keep.alias("keep"))
