"""Text functions: cleaning, sentences, tokens, stems, n-grams, previews.

All are Column expressions. Patterns stay within the syntax that Java and RE2
share, so the same strings run in other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sahaf.functions.wordlists import STOP_WORDS, SUFFIXES

# Fixed patterns.
NOT_ASCII_LETTER = r"[^a-zA-Z\s]"
NOT_LETTER = r"[^\p{L}\s]"
# A dot before a digit belongs to a date or number. Java repeats a possessive group without recursion, so any
# number of dots is taken; the possessive sign changes no match, and engines without it can leave it out.
SENTENCE = r"([^.!?\n]+(?:\.\d[^.!?\n]*)*+[.!?]*)"
TOKEN = r"(\p{L}+|\d+|[().?!,])"
WORD = r"(\p{L}+|\d+)"
CHUNK_BREAK = r"[().?!,]+"


def document_text(text: Column) -> Column:
    """Text of a document: trimmed, null becomes empty."""
    return F.coalesce(F.trim(text), F.lit(""))


def clean(text: Column, mode: str = "ascii") -> Column:
    """Letters and blanks only, lower case.

    ``ascii`` deletes every letter outside a-z; ``unicode`` keeps all letters.
    """
    return F.lower(F.regexp_replace(text, NOT_ASCII_LETTER if mode == "ascii" else NOT_LETTER, ""))


def words(text: Column, mode: str = "ascii") -> Column:
    """Cleaned words, without the empty ones that leading blanks would leave."""
    return F.filter(F.split(clean(text, mode), r"\s+"), lambda w: w != "")


def simple_tokens(text: Column) -> Column:
    """Lower-cased, split on blanks, nothing else removed."""
    return F.split(F.lower(text), r"\s+")


def sentences(text: Column) -> Column:
    """Sentences in order; they end after ``.``, ``!``, ``?`` or at a line break.

    Dates and decimals stay whole; a dot after an ordinal or an abbreviation ends one.
    """
    return F.filter(
        F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(1)), lambda s: F.trim(s) != ""
    )


def tokens(text: Column) -> Column:
    """Runs of letters, runs of digits, and each context character on its own."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))


def word_chunks(sentence: Column) -> Column:
    """Word lists of the parts of a sentence between context characters."""
    parts = F.transform(
        F.split(sentence, CHUNK_BREAK), lambda p: F.regexp_extract_all(p, F.lit(WORD), F.lit(1))
    )
    return F.filter(parts, lambda p: F.size(p) > 0)


def fold(word: Column, lang: Column | None = None) -> Column:
    """Lower case; dotted and dotless I are kept apart for Turkish."""
    plain = F.lower(word)
    if lang is None:
        return plain
    return F.when(lang == "tr", F.lower(F.translate(word, "İI", "iı"))).otherwise(plain)


def stem_pattern(lang: str) -> str:
    return r"^(\p{L}{3,}?)(?:" + "|".join(SUFFIXES[lang]) + ")$"


def stem(word: Column, lang: Column) -> Column:
    """Light stemmer on a lower-case word: drops the longest listed ending that
    leaves three letters. Languages without a list are left alone.
    """
    out = word
    for name in SUFFIXES:
        out = F.when(lang == name, F.regexp_replace(word, stem_pattern(name), "$1")).otherwise(out)
    return out


def is_stop_word(word: Column, lang: Column) -> Column:
    """Listed for the language, or shorter than three characters."""
    listed = F.lit(False)
    for name, entries in STOP_WORDS.items():
        listed = F.when(lang == name, word.isin(entries)).otherwise(listed)
    return listed | (F.length(word) < 3)


def neighbours(items: Column, most: int = 5) -> Column:
    """Array of structs ``w0 .. w<most-1>``: every entry with the entries after it."""
    return F.arrays_zip(*[F.slice(items, i + 1, F.size(items)).alias(f"w{i}") for i in range(most)])


def ngrams(row: Column, least: int = 2, most: int = 5) -> Column:
    """The n-grams that start at one row of :func:`neighbours`, as (n, gram) structs."""
    runs = [
        F.when(
            row[f"w{n - 1}"].isNotNull(),
            F.struct(
                F.lit(n).alias("n"),
                F.concat_ws(" ", *[row[f"w{i}"] for i in range(n)]).alias("gram"),
            ),
        )
        for n in range(least, most + 1)
    ]
    return F.array_compact(F.array(*runs))


def preview(text: Column, length: int = 500) -> Column:
    """The first characters of a text, with dots when it goes on."""
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)


def query_text(lang: Column | str, text: Column) -> Column:
    """Search text with its language prefix."""
    lang = F.lit(lang) if isinstance(lang, str) else lang
    return F.concat(F.lit("Dil: "), lang, F.lit(" \n "), text)


def fixed(value: Column, decimals: int) -> Column:
    """Number rendered with a fixed count of decimals."""
    return F.format_string(f"%.{decimals}f", value.cast("double"))


def file_stem(name: Column) -> Column:
    """File name without folders and its last extension."""
    return F.regexp_extract(name, r"([^/]+?)(?:\.[^./]*)?$", 1)
