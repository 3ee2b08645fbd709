"""Statute references in Turkish legal prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the wording: ordinal endings, one article ("25", "25/II-e", "8/3.", "8-10", each with or
# without an ordinal), words between articles, and words that follow them.
ORDINAL = r"(?:['’]?n?[ıiuü]?nc[ıiuü])?"
ARTICLE = r"\d{1,4}(?!\d)(?:\s*-\s*\d{1,4}(?!\d))?(?:/[\dIVX]+(?:-\p{L})?)?\.?\s*" + ORDINAL
ARTICLES = ARTICLE + r"(?:\s*(?:,|ve|ile)\s*" + ARTICLE + r")*"
# Groups: law number, name or abbreviation, articles. A name is any run of words up to the first that names a law;
# one class of characters is repeated, which takes no deep recursion however long the run is.
LAW_REFERENCE = (
    r"(\d{3,4})\s+sayılı\s+([\p{L}\s]*?(?<=\s)(?:Kanun|Yasa|yasa|kanun)|[A-ZÇĞİÖŞÜ]{2,6}['’])\p{L}*(?:['’]\p{L}+)?"
    r"(?:\s+(?:[Gg]eçici\s+|[Ee]k\s+)?(" + ARTICLES + r")\s*(?:madde|fıkra))?"
)
LEADING_LOWER = r"^(?:\p{Ll}+\s+)+"
NONE = "0"


def law_name(captured: Column) -> Column:
    """Name in the possessive form, or the abbreviation; a bare "law" names none."""
    name = F.regexp_replace(F.regexp_replace(captured, r"\s+", " "), LEADING_LOWER, "")
    return (
        F.when(name.rlike("['’]$"), F.regexp_replace(name, "['’]$", ""))
        .when(F.lower(name).isin("kanun", "yasa"), F.lit(NONE))
        .when(F.lower(name).endswith("kanun"), F.concat(name, F.lit("u")))
        .otherwise(F.concat(name, F.lit("sı")))
    )


def articles(listed: Column) -> Column:
    """Article numbers of a list, ranges written out; 0 where none is stated.

    An article has at most four digits, which bounds a range.
    """

    def numbers(item: Column) -> Column:
        ends = F.transform(F.regexp_extract_all(item, F.lit(r"\d+"), F.lit(0)), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
        low, high = ends[0], F.element_at(ends, -1)
        return F.when(high > low, F.sequence(low, high)).otherwise(ends)

    plain = F.regexp_replace(listed, r"/[\dIVX]+(?:-\p{L})?", "")
    items = F.regexp_extract_all(plain, F.lit(r"\d+(?:\s*-\s*\d+)?"), F.lit(0))
    return F.when(F.size(items) == 0, F.array(F.lit(0))).otherwise(F.flatten(F.transform(items, numbers)))


def law_references(text: Column) -> Column:
    """``array<struct<number int, law string, article int>>`` in text order.

    0 (``'0'`` for the name) where a part is missing. Several articles of one law
    ("8 inci ve 37 nci maddeleri", "17-19 uncu maddeleri") give an entry each.
    """

    def entries(match):
        group = lambda n: F.regexp_extract(match, LAW_REFERENCE, n)
        return F.transform(
            articles(group(3)),
            lambda article: F.struct(
                F.coalesce(group(1).try_cast("int"), F.lit(0)).alias("number"),
                law_name(group(2)).alias("law"),
                article.alias("article"),
            ),
        )

    return F.flatten(
        F.transform(F.regexp_extract_all(text, F.lit(LAW_REFERENCE), F.lit(0)), entries)
    )


def fill_names(references: DataFrame) -> DataFrame:
    """References (number, law, ..) with the names of bare ones filled in; ``filled`` tells which.

    A bare reference takes the name that its number has most often over all references,
    the first in code point order among equally frequent ones; '0' stays where no
    reference names the law. A number has at most four digits, so there are at most
    10,000 names and they are sent to the tasks.
    """
    named = references.where((F.col("law") != NONE) & F.col("number").between(1, 9999))
    votes = named.groupBy("number", "law").agg(F.count("*").alias("votes"))
    first = Window.partitionBy("number").orderBy(F.desc("votes"), "law")
    usual = votes.withColumn("place", F.row_number().over(first)).where("place = 1")
    usual = usual.select("number", F.col("law").alias("_usual"))
    joined = references.join(F.broadcast(usual), "number", "left")
    filled = (F.col("law") == NONE) & F.col("_usual").isNotNull()
    law = F.when(filled, F.col("_usual")).otherwise(F.col("law"))
    return joined.select(*[law.alias("law") if c == "law" else F.col(c) for c in references.columns], filled.alias("filled"))
