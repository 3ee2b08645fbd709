"""Queries on sentence ends that are learned from all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.operators import sentence_ends as S
from sahaf.plans.registry import query, quoted
from sahaf.plans.texts import documents

#: Given texts have no abbreviations: each document gets this sentence, with its own day, number and name.
DAY, NAME = "(doc_id % 28 + 1)", "chr(CAST(65 + doc_id % 26 AS INT))"
PLANTED = f"""concat(coalesce(text, ''), ' Am ', {DAY}, '. Oktober kam Prof. ', {NAME}, 'olt, z. B. mit ', {DAY}, '. der Dr. ',
    {NAME}, 'ust. Das Ende')"""


def planted(spark, folder):
    return documents(spark, folder).selectExpr("doc_id", "lang", f"{PLANTED} AS text")


def kind_sql(chunk: str) -> str:
    bare = f"lower(regexp_replace({chunk}, {quoted(S.AROUND)}, '', 'g'))"
    return f"CASE WHEN regexp_matches({bare}, {quoted(S.DIGITS)}) THEN '{S.NUMBER}' ELSE {bare} END"


def matches(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {quoted(pattern)})"


def entropy_sql(k: str, n: str) -> str:
    return f"""(CASE WHEN {k} > 0 THEN {k} * ln({k}::DOUBLE / {n}) ELSE 0 END
      + CASE WHEN {n} > {k} THEN ({n} - {k}) * ln(({n} - {k})::DOUBLE / {n}) ELSE 0 END)"""


#: No negative zeros: engines write them apart.
SHOWN = "CASE WHEN abs(score) < 0.000001 THEN 0.0 ELSE round(score, 6) END"
REST, SIZE = "(n - n_dot)", "length(replace(word, '.', ''))"
PLACES = f"""cut AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS lang,
  regexp_extract_all({PLANTED}, {quoted(S.CHUNK)}, 1) AS a FROM documents),
numbered AS (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM cut),
places AS MATERIALIZED (SELECT doc_id, lang, i, a[i] AS chunk, {kind_sql("a[i]")} AS word, {matches("a[i]", S.DOT)} AS dot,
  CASE WHEN NOT {matches("a[i]", S.LINE_END)} THEN a[i + 1] END AS after FROM numbered)"""
STATISTICS = f"""dot_words AS (SELECT lang, word, count(*) AS n, count(*) FILTER (dot) AS n_dot,
  count(*) FILTER (dot AND {matches("after", S.LOWER)}) AS n_lower FROM places WHERE word <> '' GROUP BY ALL),
dot_totals AS (SELECT lang, sum(n_dot)::DOUBLE / sum(n) AS share FROM dot_words GROUP BY lang),
statistics AS MATERIALIZED (SELECT lang, word, n, n_dot, n_lower,
  2 * (n_dot * ln({S.DOTTED}::DOUBLE) + {REST} * ln({1 - S.DOTTED!r}::DOUBLE)
    - (n_dot * ln(share) + CASE WHEN {REST} > 0 THEN {REST} * ln(1 - share) ELSE 0 END))
  * exp(-{SIZE}::DOUBLE) * (length(word) - {SIZE} + 1) * pow({SIZE}::DOUBLE, -{REST}::DOUBLE) AS score
  FROM dot_words JOIN dot_totals USING (lang) WHERE n_dot > 0)"""
NUMBERS = f"""number_words AS (SELECT lang, {kind_sql("after")} AS word, count(*) AS n,
  count(*) FILTER (word = '{S.NUMBER}') AS n_number FROM places WHERE dot AND after IS NOT NULL GROUP BY ALL),
number_totals AS (SELECT lang, sum(n) AS s, sum(n_number) AS k FROM number_words WHERE word <> '' GROUP BY lang),
numbers AS MATERIALIZED (SELECT lang, word, n, n_number, CASE WHEN n_number * s > n * k THEN
  2 * ({entropy_sql("n_number", "n")} + CASE WHEN s > n THEN {entropy_sql("(k - n_number)", "(s - n)")} ELSE 0 END
  - {entropy_sql("k", "s")}) ELSE 0 END AS score
  FROM number_words JOIN number_totals USING (lang) WHERE n_number > 0 AND word <> '')"""


@query(
    "dot_statistics",
    f"WITH {PLACES}, {STATISTICS} SELECT lang, word, n, n_dot, n_lower, CAST({SHOWN} AS DOUBLE) AS score FROM statistics",
)
def dot_statistics(spark, folder):
    """Words before dots and how much like abbreviations they are."""
    return S.dot_statistics(planted(spark, folder)).withColumn("score", F.expr(SHOWN).cast("double"))


@query(
    "after_numbers",
    f"WITH {PLACES}, {NUMBERS} SELECT lang, word, n, n_number, CAST({SHOWN} AS DOUBLE) AS score FROM numbers",
)
def after_numbers(spark, folder):
    """Words after numbers with a dot and how much closer they stand to these than to other dots."""
    return S.after_numbers(planted(spark, folder)).withColumn("score", F.expr(SHOWN).cast("double"))


@query(
    "learned_sentences",
    f"""WITH {PLACES}, {STATISTICS}, {NUMBERS},
    ends AS (SELECT p.doc_id, p.i, p.chunk, p.after IS NULL OR ({matches("p.chunk", S.END)} AND (NOT p.dot
      OR (s.word IS NULL AND (p.word <> '{S.NUMBER}' OR NOT ({matches("p.after", S.LOWER)} OR o.word IS NOT NULL))))) AS e
    FROM places p
    LEFT JOIN (SELECT lang, word FROM statistics WHERE score >= {S.ABBREVIATION} AND word <> '{S.NUMBER}') s
      ON s.lang = p.lang AND s.word = p.word
    LEFT JOIN (SELECT lang, word FROM numbers WHERE score >= {S.COLLOCATION}) o
      ON o.lang = p.lang AND o.word = {kind_sql("p.after")}),
    runs AS (SELECT *, coalesce(sum(e::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r
      FROM ends)
    SELECT doc_id, r::INT AS sent, string_agg(chunk, '' ORDER BY i) AS sentence FROM runs GROUP BY doc_id, r""",
)
def learned_sentences(spark, folder):
    """Sentences of all documents, cut at the ends learned from them."""
    return S.learned_sentences(planted(spark, folder))
