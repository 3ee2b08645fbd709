"""Text queries over ``documents``, ``pages`` and ``benchmark``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sahaf.functions import citations as C
from sahaf.functions import html as H
from sahaf.functions import text as T
from sahaf.functions.wordlists import STOP_WORDS
from sahaf.operators.embed import embed_documents, embed_texts
from sahaf.operators.graph import DAMPING, REDUNDANCY, STEPS, graph_summaries
from sahaf.operators.index import add_segment, index_search, publish
from sahaf.operators.keywords import corpus_keywords, extract_keywords
from sahaf.operators.nearest import top_k
from sahaf.operators.reduce import word2vec_documents
from sahaf.operators.search import with_texts
from sahaf.operators.summarize import summarize, summary_report
from sahaf.operators.terms import fit_hashed_tfidf, fit_terms, ngram_counts, term_counts, tfidf, tfidf_search
from sahaf.plans.registry import java_lower_words, query, quoted, replace_all, table
from sahaf.session import scratch_dir, staged
from sahaf.sources.files import convert_envelopes
from sahaf.streaming.terms import terms, update_terms

DIM = 64


def documents(spark, folder):
    return table(spark, folder, "documents")


# --- pages -----------------------------------------------------------------


def _markdown_sql() -> str:
    text = replace_all("html", H.LEADING_RULES)
    text = replace_all(text, [(H.ITEM, "\n* "), *H.ROW_RULES, *H.TRAILING_RULES])
    for name, char in [*H.ENTITIES, ("&amp;", "&")]:
        text = f"replace({text}, {quoted(name)}, {quoted(char)})"
    return f"trim({replace_all(text, H.BLANK_RULES)}, ' \n')"


@query("html_to_markdown", f"SELECT page_id, {_markdown_sql()} AS markdown FROM pages")
def html_to_markdown(spark, folder):
    return H.html_to_markdown(table(spark, folder, "pages")).select("page_id", "markdown")


@query(
    "convert_errors",
    f"""WITH broken AS (SELECT page_id,
      CASE WHEN page_id % 5 = 1 THEN NULL WHEN page_id % 5 = 2 THEN '  ' ELSE html END AS html FROM pages)
    SELECT page_id::VARCHAR AS doc_id, url AS file,
      CASE WHEN page_id % 5 IN (1, 2) THEN NULL ELSE {_markdown_sql()} END AS markdown,
      CASE WHEN page_id % 5 = 1 THEN 'no data' WHEN page_id % 5 = 2 THEN 'empty data' END AS error
    FROM broken JOIN pages p USING (page_id)""".replace("html,", "broken.html,", 0).replace(
        "(html", "(broken.html"
    ),
)
def convert_errors(spark, folder):
    """All pages as envelopes, two fifths of them without usable data."""
    kind = F.col("page_id") % 5
    damaged = F.when(kind == 1, F.lit(None)).when(kind == 2, F.lit("  ")).otherwise(F.col("html"))
    envelopes = table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("doc_id"), F.col("url").alias("file"), damaged.alias("data")
    )
    return convert_envelopes(envelopes)


# --- words and sentences ----------------------------------------------------

_PATTERN = quoted(T.SENTENCE.replace("*+", "*")).replace("{", "{{").replace("}", "}}")
SENTENCES = f"list_filter(regexp_extract_all({{0}}, {_PATTERN}, 1), lambda s: trim(s) <> '')"
WORDS = java_lower_words("{0}", T.NOT_LETTER).replace("{L}", "{{L}}")


def words_sql(column: str) -> str:
    return java_lower_words(column, T.NOT_LETTER)


@query(
    "clean_tokens",
    f"""SELECT doc_id, len(a) AS ascii_words, md5(array_to_string(a, ' ')) AS ascii_md5,
      len(u) AS words, md5(array_to_string(u, ' ')) AS words_md5
    FROM (SELECT doc_id, {java_lower_words("text", T.NOT_ASCII_LETTER)} AS a,
      {java_lower_words("text", T.NOT_LETTER)} AS u FROM documents)""",
)
def clean_tokens(spark, folder):
    cut = documents(spark, folder).select(
        "doc_id", T.words(F.col("text"), "ascii").alias("a"), T.words(F.col("text"), "unicode").alias("u")
    )
    return cut.select(
        "doc_id",
        F.size("a").cast("bigint").alias("ascii_words"),
        F.md5(F.array_join("a", " ")).alias("ascii_md5"),
        F.size("u").cast("bigint").alias("words"),
        F.md5(F.array_join("u", " ")).alias("words_md5"),
    )


@query(
    "sentences",
    f"""SELECT doc_id, unnest(s) AS sentence, (generate_subscripts(s, 1) - 1)::INT AS sent
    FROM (SELECT doc_id, {SENTENCES.format("text")} AS s FROM documents)""",
)
def sentences(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sent", "sentence")
    )


@query(
    "tokens",
    f"""SELECT doc_id, len(t) AS tokens, len(list_filter(t, lambda x: length(x) = 1 AND contains('().?!,', x))) AS marks,
      md5(array_to_string(t, ' ')) AS tokens_md5
    FROM (SELECT doc_id, regexp_extract_all(text, {quoted(T.TOKEN)}, 1) AS t FROM documents)""",
)
def tokens(spark, folder):
    cut = documents(spark, folder).select("doc_id", T.tokens(F.col("text")).alias("t"))
    marks = F.filter("t", lambda x: x.isin(list("().?!,")))
    return cut.select(
        "doc_id",
        F.size("t").cast("bigint").alias("tokens"),
        F.size(marks).cast("bigint").alias("marks"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"),
    )


def stem_sql(word: str, lang: str) -> str:
    cases = " ".join(
        f"WHEN '{name}' THEN regexp_replace({word}, {quoted(T.stem_pattern(name))}, '\\1')"
        for name in ("en", "fr", "de", "es", "tr")
    )
    return f"CASE {lang} {cases} ELSE {word} END"


@query(
    "stems",
    f"""SELECT lang, word, {stem_sql("word", "lang")} AS stem, n FROM
      (SELECT lang, word, count(*) AS n FROM
        (SELECT lang, unnest({words_sql("text")}) AS word FROM documents) GROUP BY ALL)""",
)
def stems(spark, folder):
    """Stem of every distinct word of every language."""
    words = documents(spark, folder).select("lang", F.explode(T.words(F.col("text"), "unicode")).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("lang", "word", T.stem(F.col("word"), F.col("lang")).alias("stem"), "n")


@query(
    "keyword_ngrams",
    f"""WITH w AS (SELECT doc_id, {words_sql("text")} AS w FROM documents),
    p AS (SELECT doc_id, unnest(w) AS w0, generate_subscripts(w, 1) AS pos FROM w),
    l AS (SELECT doc_id, w0, {", ".join(f"lead(w0, {i}) OVER o AS w{i}" for i in range(1, 5))}
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    runs AS ({" UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, concat_ws(' ', {', '.join(f'w{i}' for i in range(n))}) AS gram FROM l WHERE w{n - 1} IS NOT NULL"
        for n in range(2, 6))}),
    counted AS (SELECT doc_id, n, gram, count(*) AS c FROM runs GROUP BY ALL)
    SELECT doc_id, n::INT AS n, sum(c)::BIGINT AS grams, count(*) AS distinct_grams, max(c) AS most FROM counted GROUP BY doc_id, n""",
)
def keyword_ngrams(spark, folder):
    """Word n-grams of 2 to 5 words, counted per document."""
    counted = ngram_counts(documents(spark, folder))
    return counted.groupBy("doc_id", "n").agg(
        F.sum("count").alias("grams"), F.count(F.lit(1)).alias("distinct_grams"), F.max("count").alias("most")
    )


# --- weights and search -----------------------------------------------------

COUNTS = f"""
words AS (SELECT doc_id, unnest({words_sql("text")}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM counts GROUP BY term),
weights AS (SELECT doc_id, term, tf, tf * idf AS weight FROM counts JOIN idf USING (term))
"""
ASKED = f"""
asked AS (SELECT item_id AS query_id, term, count(*) AS tf FROM
  (SELECT item_id, unnest({words_sql("text")}) AS term FROM benchmark) GROUP BY ALL),
asked_weights AS (SELECT query_id, term, tf * coalesce(idf, ln((SELECT count(*) FROM documents) + 1)) AS weight
  FROM asked LEFT JOIN idf USING (term))
"""


@query("term_freq", f"WITH {COUNTS} SELECT doc_id, term, tf FROM counts")
def term_freq(spark, folder):
    return term_counts(documents(spark, folder), move_texts=True)


@query("tfidf", f"WITH {COUNTS} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, folder):
    return tfidf(documents(spark, folder)).withColumn("weight", F.round("weight", 6))


TFIDF_SEARCH = f"""WITH {COUNTS}, {ASKED},
    dl AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM weights GROUP BY doc_id),
    ql AS (SELECT query_id, sqrt(sum(weight * weight)) AS len FROM asked_weights GROUP BY query_id),
    products AS (SELECT query_id, doc_id, sum(a.weight * w.weight) AS s
      FROM asked_weights a JOIN weights w USING (term) GROUP BY query_id, doc_id),
    scored AS (SELECT query_id, doc_id, round(s / dl.len / ql.len, 10) AS score
      FROM products JOIN dl USING (doc_id) JOIN ql USING (query_id) WHERE s > 0),
    ranked AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id))::INT AS rank FROM scored)
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"""


@query("tfidf_search", TFIDF_SEARCH)
def tfidf_search_topk(spark, folder):
    """Benchmark items as search texts over all documents."""
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return tfidf_search(documents(spark, folder), asked, 10).select(
        "query_id", "rank", F.col("id").alias("doc_id"), F.round("score", 6).alias("score")
    )


@query("stream_terms", f"WITH {COUNTS} SELECT term, count(*) AS df, round(any_value(idf), 9) AS idf FROM counts JOIN idf USING (term) GROUP BY term")
def stream_terms(spark, folder):
    """Frequencies of all documents from three batches, the second of which comes twice."""
    place = f"{scratch_dir(spark)}/terms-{uuid.uuid4().hex}"
    docs = documents(spark, folder).select("doc_id", "text")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    for batch in (0, 1, 1, 2):
        update_terms(docs.where(part == batch), place, batch)
    return terms(spark, place).table.select("term", "df", F.round("idf", 9).alias("idf"))


@query("index_search", TFIDF_SEARCH)
def index_search_topk(spark, folder):
    """The same hits from an index of two segments."""
    place = f"{scratch_dir(spark)}/index-{uuid.uuid4().hex}"
    docs = documents(spark, folder).select("doc_id", "text")
    first = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0  # xxhash64 gives a null id a number, too
    add_segment(docs.where(first), place)
    add_segment(docs.where(~first), place)
    publish(spark, place)
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = index_search(spark, place, asked, 10)
    return found.select("query_id", "rank", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query("tfidf_hashed")
def tfidf_hashed(spark, folder):
    """Hashed TF-IDF vectors of 10,000 components: how many are set, and their length."""
    from pyspark.ml.functions import vector_to_array

    _, vectors = fit_hashed_tfidf(documents(spark, folder).select("doc_id", "text"))
    weights = F.filter(vector_to_array("vector"), lambda x: x != 0.0)
    listed = vectors.select("doc_id", weights.alias("w"))
    length = F.sqrt(F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x * x))
    return listed.select("doc_id", F.size("w").alias("terms"), F.round(length, 6).alias("length"))


# --- embeddings and summaries -----------------------------------------------


def embedded_sql(name: str, docs: str, weights: str) -> str:
    """CTEs ending in ``name(doc_id, vec DOUBLE[])``, float32 values."""
    return f"""
{name}_parts AS (SELECT doc_id, (('0x' || substr(md5(term), 1, 8))::BIGINT % {DIM})::INT AS pos,
  sum(CASE WHEN ('0x' || substr(md5(term), 9, 1))::BIGINT % 2 = 0 THEN weight ELSE -weight END) AS value
  FROM {weights} GROUP BY 1, 2),
{name}_dense AS (SELECT doc_id, list(coalesce(value, 0) ORDER BY g.pos) AS v
  FROM (SELECT doc_id, unnest(range(0, {DIM}))::INT AS pos FROM {docs}) g
  LEFT JOIN {name}_parts p USING (doc_id, pos) GROUP BY doc_id),
{name} AS (SELECT doc_id, list_transform(v, lambda x: (CASE WHEN n = 0 THEN 0 ELSE x / n END)::FLOAT::DOUBLE) AS vec
  FROM (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM {name}_dense))
"""


@query(
    "embed_documents",
    f"""WITH {COUNTS}, {embedded_sql("embedded", "documents", "weights")}
    SELECT doc_id, (generate_subscripts(vec, 1) - 1)::INT AS pos, round(unnest(vec), 6) + 0.0 AS value FROM embedded""",
)
def embed(spark, folder):
    return embed_documents(documents(spark, folder), DIM).select(
        "doc_id", F.posexplode("vec").alias("pos", "x")
    ).select("doc_id", "pos", (F.round(F.col("x").cast("double"), 6) + F.lit(0.0)).alias("value"))


@query(
    "semantic_search",
    f"""WITH {COUNTS}, {ASKED}, {embedded_sql("embedded", "documents", "weights")},
    q AS (SELECT item_id AS doc_id FROM benchmark),
    qw AS (SELECT query_id AS doc_id, term, weight FROM asked_weights),
    {embedded_sql("asking", "q", "qw")},
    scored AS (SELECT a.doc_id AS query_id, e.doc_id, list_dot_product(a.vec, e.vec) AS score FROM asking a, embedded e),
    ranked AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id))::INT AS rank FROM scored)
    SELECT query_id, rank, doc_id, round(score, 6) AS score,
      CASE WHEN length(text) > 500 THEN text[1:500] || '...' ELSE text END AS preview
    FROM ranked JOIN documents USING (doc_id) WHERE rank <= 5""",
)
def semantic_search(spark, folder):
    """Embed texts and documents alike, search by inner product, join the text last."""
    docs = documents(spark, folder)
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    counts = staged(term_counts(docs, move_texts=True), "counts")
    model = fit_terms(docs, counts).kept()
    corpus = embed_documents(docs, DIM, model, counts).withColumnRenamed("doc_id", "id")
    queries = embed_texts(asked, model, DIM).toDF("query_id", "query_vec")
    found = top_k(corpus, queries, 5, "ip").withColumnRenamed("id", "doc_id")
    return with_texts(found, docs, "doc_id").select(
        "query_id", "rank", "doc_id", F.round("score", 6).alias("score"), T.preview(F.col("text")).alias("preview")
    )


SUMMARY = f"""
sents AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS sent
  FROM (SELECT doc_id, {SENTENCES.format("text")} AS s FROM documents)),
places AS (SELECT doc_id, sent, unnest({words_sql("sentence")}) AS term FROM sents),
stf AS (SELECT doc_id, term, count(*) AS tf FROM places GROUP BY ALL),
sidf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM stf GROUP BY term),
sscore AS (SELECT doc_id, sent, round(avg(tf * idf), 10) AS score
  FROM places JOIN stf USING (doc_id, term) JOIN sidf USING (term) GROUP BY doc_id, sent),
picked AS (SELECT doc_id, sent, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sent) AS r FROM sscore),
summaries AS (SELECT d.doc_id, coalesce(string_agg(trim(sentence), ' ' ORDER BY p.sent), '') AS summary
  FROM documents d LEFT JOIN (SELECT * FROM picked WHERE r <= 3) p USING (doc_id)
  LEFT JOIN sents s ON s.doc_id = p.doc_id AND s.sent = p.sent GROUP BY d.doc_id)
"""


@query("extractive_summary", f"WITH {SUMMARY} SELECT doc_id, summary FROM summaries")
def extractive_summary(spark, folder):
    return summarize(documents(spark, folder))


def graph_sql() -> str:
    """CTEs ending in ``graph_picks(doc_id, sent)``, from ``places`` and ``sidf``."""
    by = "OVER (PARTITION BY doc_id, {})".format
    parts = [
        "gv AS (SELECT doc_id, sent, term, count(*) * any_value(idf) AS v FROM places JOIN sidf USING (term)"
        " WHERE idf > 0 GROUP BY doc_id, sent, term)",
        f"gx AS (SELECT *, v / sqrt(sum(v * v) {by('sent')}) AS x FROM gv)",
        f"gd AS (SELECT *, sum(x) {by('term')} AS across FROM gx)",
        f"g0 AS MATERIALIZED (SELECT doc_id, sent, term, x, sum(x * across) {by('sent')} AS degree, 1.0::DOUBLE AS rank FROM gd)",
    ]
    for k in range(STEPS):
        parts += [
            f"ga{k} AS (SELECT *, sum(x * rank / degree) {by('term')} AS across FROM g{k})",
            f"g{k + 1} AS MATERIALIZED (SELECT doc_id, sent, term, x, degree,"
            f" {1 - DAMPING} + {DAMPING} * sum(x * across) {by('sent')} AS rank FROM ga{k})",
        ]
    parts.append(f"m0 AS (SELECT doc_id, sent, term, x, rank, 0.0::DOUBLE AS near, false AS taken FROM g{STEPS})")
    for k in range(3):
        parts += [
            f"mw{k} AS (SELECT *, min(CASE WHEN NOT taken THEN {{'w': -round(rank * (1 - {REDUNDANCY} * near), 10), 's': sent}} END)"
            f" OVER (PARTITION BY doc_id) AS best FROM m{k})",
            f"mp{k} AS (SELECT *, coalesce(max(CASE WHEN sent = best.s THEN x END) {by('term')}, 0) AS across FROM mw{k})",
            f"m{k + 1} AS MATERIALIZED (SELECT doc_id, sent, term, x, rank, greatest(near, sum(x * across) {by('sent')}) AS near,"
            f" taken OR coalesce(sent = best.s, false) AS taken FROM mp{k})",
        ]
    parts.append("graph_picks AS (SELECT DISTINCT doc_id, sent FROM m3 WHERE taken)")
    return ",\n".join(parts)


@query(
    "graph_summary",
    f"""WITH {SUMMARY}, {graph_sql()}
    SELECT d.doc_id, coalesce(string_agg(trim(sentence), ' ' ORDER BY p.sent), '') AS summary
    FROM documents d LEFT JOIN graph_picks p USING (doc_id)
    LEFT JOIN sents s ON s.doc_id = p.doc_id AND s.sent = p.sent GROUP BY d.doc_id""",
)
def graph_summary(spark, folder):
    """Summaries from the graph of each document's sentences."""
    return graph_summaries(documents(spark, folder))


@query(
    "pair_cosine",
    f"""WITH {COUNTS}, {embedded_sql("embedded", "documents", "weights")}, {SUMMARY},
    sw AS (SELECT doc_id, term, count(*) * coalesce(any_value(idf), ln((SELECT count(*) FROM documents) + 1)) AS weight
      FROM (SELECT doc_id, unnest({words_sql("summary")}) AS term FROM summaries) LEFT JOIN idf USING (term) GROUP BY doc_id, term),
    {embedded_sql("short", "documents", "sw")},
    keyed AS (SELECT doc_id, lang, {{'h': md5(doc_id::VARCHAR), 'id': doc_id, 'lang': lang}} AS rep,
      ('0x' || substr(md5(doc_id::VARCHAR), 1, 6))::BIGINT % 256 AS own FROM documents),
    slotted AS (SELECT own AS slot, lang, rep FROM keyed UNION ALL SELECT -1, lang, rep FROM keyed),
    first AS (SELECT slot, min(rep) AS a FROM slotted GROUP BY slot),
    second AS (SELECT slot, min(rep) AS b FROM slotted JOIN first USING (slot) WHERE lang <> a.lang GROUP BY slot),
    reps AS (SELECT slot, a, b FROM first LEFT JOIN second USING (slot)),
    pairs AS (SELECT k.doc_id, coalesce(CASE WHEN o.a.lang <> k.lang THEN o.a.id ELSE o.b.id END,
        CASE WHEN w.a.lang <> k.lang THEN w.a.id ELSE w.b.id END) AS other_id
      FROM keyed k LEFT JOIN reps o ON o.slot = k.own LEFT JOIN reps w ON w.slot = -1)
    SELECT p.doc_id, round(CASE WHEN list_sum(s.vec) IS NULL OR list_dot_product(s.vec, s.vec) = 0 OR list_dot_product(e.vec, e.vec) = 0
        THEN 0 ELSE list_cosine_similarity(e.vec, s.vec) END, 6) AS cos_summary,
      round(CASE WHEN list_dot_product(o.vec, o.vec) = 0 OR list_dot_product(e.vec, e.vec) = 0
        THEN 0 ELSE list_cosine_similarity(e.vec, o.vec) END, 6) AS cos_other
    FROM pairs p JOIN embedded e ON e.doc_id = p.doc_id JOIN short s ON s.doc_id = p.doc_id
    LEFT JOIN embedded o ON o.doc_id = p.other_id""",
)
def pair_cosine(spark, folder):
    """Each document against its summary and against one of another language."""
    report = summary_report(documents(spark, folder), DIM)
    return report.select("doc_id", *[F.round(c, 6).alias(c) for c in ("cos_summary", "cos_other")])


@query("word2vec_doc")
def word2vec(spark, folder):
    vectors = word2vec_documents(documents(spark, folder), size=128)
    return vectors.select("doc_id", F.size("vec").alias("dim"), F.round(F.get("vec", F.lit(0)), 6).alias("first"))


# --- keywords ---------------------------------------------------------------


def stop_sql(word: str, lang: str) -> str:
    cases = " ".join(
        f"WHEN '{name}' THEN {word} IN ({', '.join(map(quoted, entries))})"
        for name, entries in STOP_WORDS.items()
    )
    return f"(CASE {lang} {cases} ELSE false END OR length({word}) < 3)"


KEYWORDS = f"""
d AS (SELECT doc_id, lang, {SENTENCES.format("text")} AS s FROM documents),
sents AS (SELECT doc_id, lang, len(s) AS n_sents, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS sent FROM d),
cut AS (SELECT doc_id, lang, n_sents, sent, list_filter(list_transform(
    string_split_regex(sentence, {quoted(T.CHUNK_BREAK)}), lambda p: regexp_extract_all(p, {quoted(T.WORD)}, 1)), lambda p: len(p) > 0) AS c FROM sents),
chunks AS (SELECT doc_id, lang, n_sents, sent, unnest(c) AS words, generate_subscripts(c, 1) - 1 AS chunk FROM cut),
surfaces AS (SELECT doc_id, lang, n_sents, sent, chunk, unnest(words) AS surface, generate_subscripts(words, 1) - 1 AS pos FROM chunks),
placed AS (SELECT *, lower(surface) AS word,
    lag(lower(surface)) OVER w AS before, lead(lower(surface)) OVER w AS after
  FROM surfaces WINDOW w AS (PARTITION BY doc_id, sent, chunk ORDER BY pos)),
tok AS (SELECT *, {stem_sql("word", "lang")} AS stem, {stop_sql("word", "lang")} AS is_stop,
    regexp_matches(surface, '^\\p{{Lu}}{{2,}}$') AS acronym, regexp_matches(surface, '^\\p{{Lu}}') AS upper FROM placed),
stats AS (SELECT doc_id, stem, count(*) AS tf,
    count(*) FILTER (upper AND NOT acronym AND NOT (chunk = 0 AND pos = 0)) AS tf_capital,
    count(*) FILTER (acronym) AS tf_acronym, median(sent) AS middle, count(DISTINCT sent) AS sents,
    count(before) AS n_before, count(after) AS n_after, count(DISTINCT before) AS d_before, count(DISTINCT after) AS d_after,
    bool_and(is_stop) AS stop, max(n_sents) AS n_sents FROM tok GROUP BY doc_id, stem),
per_doc AS (SELECT doc_id, avg(tf) FILTER (NOT stop) AS mean_tf, stddev_pop(tf) FILTER (NOT stop) AS std_tf, max(tf) AS max_tf
  FROM stats GROUP BY doc_id),
features AS (SELECT doc_id, stem, stop, greatest(tf_capital, tf_acronym) / (1 + ln(tf)) AS cas, ln(ln(3 + middle)) AS pos,
    tf / coalesce(mean_tf + std_tf, 1) AS norm,
    1 + (CASE WHEN n_before > 0 THEN d_before / n_before ELSE 0 END
       + CASE WHEN n_after > 0 THEN d_after / n_after ELSE 0 END) * tf / max_tf AS rel,
    sents / n_sents AS spread FROM stats JOIN per_doc USING (doc_id)),
scores AS (SELECT doc_id, stem, stop, rel * pos / (cas + norm / rel + spread / rel) AS s FROM features),
line AS (SELECT t.doc_id, sent, chunk, t.pos, t.stem, s.stop, s.s FROM tok t JOIN scores s ON s.doc_id = t.doc_id AND s.stem = t.stem),
runs AS (SELECT doc_id, stop, {", ".join(f"lead(stem, {i}) OVER w AS w{i}, lead(s, {i}) OVER w AS s{i}, lead(stop, {i}) OVER w AS x{i}" for i in range(1, 5))},
    stem AS w0, s AS s0 FROM line WINDOW w AS (PARTITION BY doc_id, sent, chunk ORDER BY pos)),
grams AS ({" UNION ALL ".join(
    f"SELECT doc_id, concat_ws(' ', {', '.join(f'w{i}' for i in range(n))}) AS keyword,"
    f" {' * '.join(f's{i}' for i in range(n))} AS p, {' + '.join(f's{i}' for i in range(n))} AS t"
    f" FROM runs WHERE NOT stop AND NOT x{n - 1}" for n in range(2, 6))}),
candidates AS (SELECT doc_id, keyword, max(p) / (count(*) * (1 + max(t))) AS score FROM grams GROUP BY doc_id, keyword),
ranked AS (SELECT doc_id, keyword, score,
    (row_number() OVER (PARTITION BY doc_id ORDER BY round(ln(score), 9), keyword))::INT AS rank
  FROM candidates WHERE score <= 0.6),
kept AS (SELECT * FROM ranked WHERE rank <= 20)
"""


@query("keywords_per_doc", f"WITH {KEYWORDS} SELECT doc_id, rank, keyword, round(score, 9) AS score FROM kept")
def keywords_per_doc(spark, folder):
    found = extract_keywords(documents(spark, folder))
    return found.select("doc_id", "rank", "keyword", F.round("score", 9).alias("score"))


@query(
    "keywords_corpus",
    f"WITH {KEYWORDS} SELECT keyword, round(min(score), 9) AS score FROM kept GROUP BY keyword",
)
def keywords_corpus(spark, folder):
    """Keywords of all documents, the best score of each."""
    found = extract_keywords(documents(spark, folder))
    return corpus_keywords(found).select("keyword", F.round("score", 9).alias("score"))


# --- law references ---------------------------------------------------------

# Wordings of laws and of articles, and by hand the name and the articles that each of them states.
LAWS = [
    ("İş Kanununun", "İş Kanunu"), ("Türk Medenî Kanununun", "Türk Medenî Kanunu"), ("yasanın", "0"),
    ("önceki İş Yasasının", "İş Yasası"), ("Borçlar Kanununda", "Borçlar Kanunu"), ("HMK'nın", "HMK"),
    ("İş Kanunu'nun", "İş Kanunu"), ("Basın Yasası’nın", "Basın Yasası"),
    ("Sosyal Sigortalar ve Genel Sağlık Sigortası Kanununun", "Sosyal Sigortalar ve Genel Sağlık Sigortası Kanunu"),
    ("Kamu Görevlileri Sendikaları ve Toplu Sözleşme Kanunu'nun", "Kamu Görevlileri Sendikaları ve Toplu Sözleşme Kanunu"),
]
FORMS = [
    (" üncü maddesinde", []), (" inci ve 7 nci maddelerinin", [7]), (". maddesi", []), ("nci maddenin", []),
    (" sayfasında", None), (", 18 ve 19 uncu maddeleri", [18, 19]), ("/II-e maddesi", []), ("/3. fıkrası", []),
    (" ve 8-10 uncu maddeleri", [8, 9, 10]), (" ve 1-150 nci maddeleri", list(range(1, 151))),
]


def _stated_sql(number: str, law: str, article: str, form: str) -> str:
    """Rows that one injected reference states, from its parts and not from a pattern."""
    names = [x for _, x in LAWS]
    more = ", ".join("NULL" if x is None else f"range({x[0]}, {x[-1] + 1})::INT[]" if x else "[]::INT[]" for _, x in FORMS)
    own = f"([{more}])[{form}]"
    return f"""SELECT doc_id, ({number})::INT AS number, ({names})[{law}] AS law,
      unnest(CASE WHEN {own} IS NULL THEN [0] ELSE list_concat([({article})::INT], {own}) END) AS article FROM documents"""


STATED = (
    _stated_sql("1000 + doc_id % 9000", f"doc_id % {len(LAWS)} + 1", "doc_id % 400 + 1", f"doc_id // 5 % {len(FORMS)} + 1")
    + " UNION ALL "
    + _stated_sql("100 + doc_id % 900", f"doc_id // 3 % {len(LAWS)} + 1", "doc_id % 90 + 1", f"doc_id // 7 % {len(FORMS)} + 1")
)


def references(spark, folder):
    pick = lambda entries, i: F.get(F.array(*[F.lit(x) for x, _ in entries]), (i % len(entries)).cast("int"))
    i = F.col("doc_id")
    legal = F.concat(
        1000 + i % 9000, F.lit(" sayılı "), pick(LAWS, i), F.lit(" "), i % 400 + 1, pick(FORMS, F.floor(i / 5)),
        F.lit(" "), F.col("text"), F.lit(" "),
        100 + i % 900, F.lit(" sayılı "), pick(LAWS, F.floor(i / 3)), F.lit(" "), i % 90 + 1, pick(FORMS, F.floor(i / 7)),
    )
    found = documents(spark, folder).select("doc_id", F.explode(C.law_references(legal)).alias("r"))
    return found.select("doc_id", "r.*")


@query("citations", STATED)
def citations(spark, folder):
    """Law references in the documents, each given two in the wording of court texts."""
    return references(spark, folder)


@query(
    "citations_named",
    f"""WITH r AS ({STATED}),
    v AS (SELECT number, law, count(*) AS n FROM r WHERE law <> '0' GROUP BY ALL),
    u AS (SELECT number, law AS usual FROM v QUALIFY row_number() OVER (PARTITION BY number ORDER BY n DESC, law) = 1)
    SELECT doc_id, number, CASE WHEN law = '0' AND usual IS NOT NULL THEN usual ELSE law END AS law, article,
      law = '0' AND usual IS NOT NULL AS filled FROM r LEFT JOIN u USING (number)""",
)
def citations_named(spark, folder):
    """The same, bare laws named as most references of their number name them."""
    return C.fill_names(references(spark, folder))
