"""Sentence ends learned from the corpus, language by language, without word lists.

A dot after an abbreviation or an ordinal ends no sentence. Both are found by collocation
statistics over all documents. An abbreviation is a short word that is hardly ever seen
without its dot: the log likelihood of word and dot, scaled by length, inner dots and
occurrences without a dot. An ordinal is a number with a dot before a lower-case word, or
before a word that follows numbers with a dot far more often than it follows other dots
(months, "Madde"); a word that merely begins many sentences follows all dots alike.

Statistics are sums by language and word, combined before the shuffle. They are written as
tables and joined with the words before dots alone, so small ones are sent to the tasks by
their known size and large ones meet by a shuffle. Texts move once, to their ends.

Documents come as ``doc_id, text, lang``; other columns don't matter. A null or blank text
has no sentences, a null language is the language ``''``. Repeated rows and rows without
``doc_id`` are documents of their own. A text of any length is split whole. Words at a
threshold count as reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.session import staged

# Fixed patterns, in the syntax that Java and RE2 share.
CHUNK = r"([ \t\r\f\n]*[^ \t\r\f\n]+(?:[ \t\r\f]*\n)?)"
AROUND = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
DIGITS = r"^[0-9]+$"
DOT = r"[\p{L}\p{N}]\.[\"'”’»)\]]*[ \t\r\f\n]*$"
END = r"[.!?][\"'”’»)\]]*[ \t\r\f\n]*$"
LINE_END = r"\n$"
LOWER = r"^[^\p{L}\p{N}]*\p{Ll}"
NUMBER = "#"

# Published values: the chance of a dot after an abbreviation, and the least scores.
DOTTED, ABBREVIATION, COLLOCATION = 0.99, 0.3, 7.88


def chunks(text: Column) -> Column:
    """Runs without blanks, each with the blanks before it and the line break after it; they join to the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(1))


def kind(chunk: Column) -> Column:
    """Word of a chunk in lower case, without signs around it; one sign for all numbers."""
    bare = F.lower(F.regexp_replace(chunk, AROUND, ""))
    return F.when(bare.rlike(DIGITS), F.lit(NUMBER)).otherwise(bare)


def places(docs: DataFrame) -> DataFrame:
    """Adds i, chunk and after (the next chunk of the line) to ``keep..``, ``lang``, from column ``text``."""
    others = [c for c in docs.columns if c not in ("text", "lang")]
    cut = docs.select(*others, F.coalesce("lang", F.lit("")).alias("lang"), chunks(F.col("text")).alias("all"))
    pairs = F.arrays_zip(F.col("all").alias("chunk"), F.slice("all", 2, F.greatest(F.size("all"), F.lit(1))).alias("after"))
    rows = cut.select(*others, "lang", F.posexplode(pairs).alias("i", "p"))
    after = F.when(~F.col("p.chunk").rlike(LINE_END), F.col("p.after"))
    return rows.select(*others, "lang", "i", F.col("p.chunk").alias("chunk"), after.alias("after"))


def dot_statistics(docs: DataFrame) -> DataFrame:
    """(lang, word, n, n_dot, n_lower, score) of every word that stands before a dot.

    ``n_dot`` of its ``n`` occurrences have a dot, ``n_lower`` of those are followed by a
    lower-case word. Numbers count as one word.
    """
    rows = places(docs.select("text", "lang"))
    dot = F.col("chunk").rlike(DOT)
    low = dot & F.coalesce(F.col("after").rlike(LOWER), F.lit(False))
    seen = rows.select("lang", kind(F.col("chunk")).alias("word"), dot.cast("long").alias("dot"), low.cast("long").alias("low"))
    words = seen.where("word <> ''").groupBy("lang", "word").agg(
        F.count("*").alias("n"), F.sum("dot").alias("n_dot"), F.sum("low").alias("n_lower")
    )
    words = staged(words, "dot-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all"), F.sum("n_dot").alias("all_dot"))
    found = words.where("n_dot > 0").join(F.broadcast(totals), "lang")
    n, n_dot, rest = F.col("n"), F.col("n_dot"), F.col("n") - F.col("n_dot")
    share = F.col("all_dot") / F.col("all")
    # Where every word has a dot no word is without, and the second summand is nothing.
    null = n_dot * F.log(share) + F.when(rest > 0, rest * F.log(1 - share)).otherwise(0.0)
    likely = 2 * (n_dot * F.log(F.lit(DOTTED)) + rest * F.log(F.lit(1 - DOTTED)) - null)
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    inner = F.length("word") - letters
    score = likely * F.exp(-letters) * (inner + 1) * F.pow(letters, -rest.cast("double"))
    return found.select("lang", "word", "n", "n_dot", "n_lower", score.alias("score"))


def abbreviations(statistics: DataFrame, least: float = ABBREVIATION) -> DataFrame:
    """(lang, word) of the abbreviations among :func:`dot_statistics`."""
    return statistics.where((F.col("score") >= least) & (F.col("word") != NUMBER)).select("lang", "word")


def entropy(k: Column, n: Column) -> Column:
    """Log likelihood of ``k`` hits in ``n`` at their own rate."""
    part = F.when(k > 0, k * F.log(k / n)).otherwise(0.0)
    return part + F.when(n > k, (n - k) * F.log((n - k) / n)).otherwise(0.0)


def after_numbers(docs: DataFrame) -> DataFrame:
    """(lang, word, n, n_number, score) of words after a dot: of ``n``, ``n_number`` follow a number with a dot.

    ``score`` is the log likelihood ratio of the two rates, 0 where a word follows numbers no
    more often than other words do.
    """
    rows = places(docs.select("text", "lang")).where(F.col("chunk").rlike(DOT) & F.col("after").isNotNull())
    number = (kind(F.col("chunk")) == NUMBER).cast("long")
    seen = rows.select("lang", kind(F.col("after")).alias("word"), number.alias("number")).where("word <> ''")
    words = staged(seen.groupBy("lang", "word").agg(F.count("*").alias("n"), F.sum("number").alias("n_number")), "number-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all"), F.sum("n_number").alias("all_number"))
    found = words.where("n_number > 0").join(F.broadcast(totals), "lang")
    n, k, every, numbers = (F.col(c) for c in ("n", "n_number", "all", "all_number"))
    apart = entropy(k, n) + F.when(every > n, entropy(numbers - k, every - n)).otherwise(0.0)
    more = k * every > n * numbers
    score = F.when(more, 2 * (apart - entropy(numbers, every))).otherwise(0.0)
    return found.select("lang", "word", "n", "n_number", score.alias("score"))


def ordinal_words(counts: DataFrame, least: float = COLLOCATION) -> DataFrame:
    """(lang, word) of the words among :func:`after_numbers` before which a number's dot ends no sentence."""
    return counts.where(F.col("score") >= least).select("lang", "word")


def sentences(docs: DataFrame, short: DataFrame, ordinals: DataFrame) -> DataFrame:
    """(doc_id, sent, sentence) of documents, given their abbreviations and the words after ordinals.

    A sentence ends at a line break, after ``!`` and ``?``, and after a dot that belongs to no
    abbreviation or ordinal. The sentences of a text join to the text, but for blanks at its end.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("no"), "doc_id", "lang", "text")
    rows = staged(numbered, "sentence-rows")
    marks = places(rows.select("no", "lang", "text")).where(F.col("chunk").rlike(END) | F.col("after").isNull())
    doubtful = F.col("chunk").rlike(DOT) & F.col("after").isNotNull()
    word = F.when(doubtful, kind(F.col("chunk")))
    after = F.when(word == NUMBER, kind(F.col("after")))
    low = (word == NUMBER) & F.col("after").rlike(LOWER)
    marks = marks.select("no", "i", "lang", word.alias("word"), after.alias("next"), F.coalesce(low, F.lit(False)).alias("low"))
    short = staged(short.select("lang", "word", F.lit(True).alias("is_short")), "sentence-short")
    ordinals = staged(ordinals.select("lang", F.col("word").alias("next"), F.lit(True).alias("is_ordinal")), "sentence-ordinals")
    # Sure ends, the most by far, have nothing to look up and stay out of the joins.
    sure = marks.where("word IS NULL").select("no", "i")
    asked = marks.where("word IS NOT NULL").join(short, ["lang", "word"], "left").join(ordinals, ["lang", "next"], "left")
    ends = sure.union(asked.where("NOT low AND is_short IS NULL AND is_ordinal IS NULL").select("no", "i"))
    ends = ends.groupBy("no").agg(F.array_sort(F.collect_list("i")).alias("ends"))
    cut = rows.select("no", "doc_id", chunks(F.col("text")).alias("all")).join(ends, "no")
    starts = F.concat(F.array(F.lit(-1)), F.slice("ends", 1, F.size("ends") - 1))
    spans = cut.select("doc_id", "all", F.posexplode(F.arrays_zip(starts.alias("before"), F.col("ends").alias("last"))).alias("sent", "s"))
    own = F.slice("all", F.col("s.before") + 2, F.col("s.last") - F.col("s.before"))
    return spans.select("doc_id", "sent", F.array_join(own, "").alias("sentence"))


def learned_sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, sent, sentence) of documents, with abbreviations and ordinals learned from the same documents."""
    return sentences(docs, abbreviations(dot_statistics(docs)), ordinal_words(after_numbers(docs)))
