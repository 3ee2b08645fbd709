"""Query on stems by ordered steps with regions; the SQL runs the same steps in another engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.operators.stemming import STEMMERS, chained_sql, stem_words
from sahaf.plans.registry import query
from sahaf.plans.texts import documents, words_sql

OTHERS = ", ".join(f"'{x}'" for x in STEMMERS)


@query(
    "region_stems",
    f"""WITH counted AS MATERIALIZED (SELECT lang, word, count(*) AS n FROM
      (SELECT lang, unnest({words_sql("text")}) AS word FROM documents) GROUP BY ALL),
    stemmed AS ({" UNION ALL ".join(chained_sql("counted", x) for x in STEMMERS)}
      UNION ALL SELECT lang, word, lower(word) FROM counted WHERE lang NOT IN ({OTHERS}))
    SELECT lang, word, stem, n FROM counted JOIN stemmed USING (lang, word)
    UNION ALL SELECT lang, word, lower(word), n FROM counted WHERE lang IS NULL""",
)
def region_stems(spark, folder):
    """Every distinct word of every language with its stem and how often it occurs."""
    words = documents(spark, folder).select("lang", F.explode(T.words(F.col("text"), "unicode")).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    # Counts pass the steps with their word, so nothing is joined.
    return stem_words(counted, "n")
