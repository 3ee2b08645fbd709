"""One query per operator over its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.llm import (
    fingerprints,
    hosts,
    itq,
    lines,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    resampling,
    sharding,
    token_counts,
    warc,
)
from sahaf.llm.frames import table
from sahaf.llm.registry import query


OP1_SQL = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
  f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark, folder):
    rows = warc.archive_pages(table(spark, folder, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def vocabulary() -> str:
    """The vocabulary file of the box; ``packing`` takes its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_pack")
def op2_pack(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, vocabulary(), packing.LENGTH)


def trusted_ids(spark, folder):
    """Documents labelled as good and not toxic."""
    return table(spark, folder, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


@query("op3_quality")
def op3_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    out = quality.classify(docs, trusted_ids(spark, folder))
    return out.select("doc_id", "lang", "n_words", "perplexity", "limit", "keep")


OP4_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
  s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
  e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
  l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  y AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r AS (SELECT doc_id AS d, doc_id AS c FROM s UNION SELECT y.a, r.c FROM r JOIN y ON y.b = r.d)
SELECT doc_id, len(any_value(s)) AS n_shingles, min(c) AS component_id FROM r JOIN s ON doc_id = d GROUP BY doc_id"""


@query("op4_ngram_join", OP4_SQL)
def op4_ngram_join(spark, folder):
    return ngram_join.similar_groups(table(spark, folder, "documents").select("doc_id", "text"))


#: Weights of the sources in turn, their share of all words, and how often a document may be taken.
WEIGHTS, SHARE, EPOCHS = [5.0, 2.0, 1.0], 1.5, 2.0


@query("op5_mix")
def op5_mix(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    out = mixing.plan(docs, WEIGHTS, SHARE, EPOCHS)
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""WITH o AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
    FROM documents),
  w AS (SELECT doc_id, no, list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM o),
  s AS (SELECT doc_id, no, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w WHERE len(w) > 0),
  c AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id, no) AS ord FROM s),
  f AS MATERIALIZED (SELECT s, min(ord) AS ord FROM c GROUP BY s),
  e AS MATERIALIZED (SELECT ord, len(s) AS n, unnest(s) AS t FROM f),
  m AS (SELECT DISTINCT a.ord FROM e a JOIN e b ON a.t = b.t AND b.ord < a.ord
    GROUP BY a.ord, b.ord, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  g AS (SELECT c.doc_id, c.no FROM c JOIN f USING (s) WHERE c.ord > f.ord OR f.ord IN (SELECT ord FROM m))
SELECT d.doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, coalesce(k.n, 0)::BIGINT AS n_removed,
  md5(CASE WHEN k.n IS NULL THEN text ELSE coalesce((SELECT string_agg(o.line, chr(10) ORDER BY o.no) FROM o
    WHERE o.doc_id = d.doc_id AND NOT list_contains(k.nos, o.no)), '') END) AS text_md5
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, list(no) AS nos FROM g GROUP BY doc_id) k USING (doc_id)"""


@query("op6_lines", OP6_SQL)
def op6_lines(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    out = lines.without_repeats(docs, removed="n_removed")
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query("op7_fingerprints")
def op7_fingerprints(spark, folder):
    return fingerprints.fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


@query("op8_itq")
def op8_itq(spark, folder):
    return itq.near_duplicates(table(spark, folder, "embeddings"), itq.MIN_COSINE)


#: Rules of the url filter: fixed values.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _sql_suffix(host: str, below: int) -> str:
    """SQL for the last labels of a host: those of its suffix and ``below`` more."""
    listed = ", ".join(f"'{x}'" for x in hosts.TWO_LABELS)
    last = "array_to_string(string_split({h}, '.')[-{n}:], '.')".format
    name = f"regexp_replace(regexp_replace({host}, '{hosts.USER}', ''), '{hosts.PORT}', '')"
    two = last(h=name, n=2)
    named = f"WHEN {two} IN ({listed}) THEN {last(h=name, n=2 + below)} ELSE {last(h=name, n=1 + below)} END"
    return f"CASE WHEN regexp_matches({name}, '{hosts.ADDRESS}') THEN {name} {named}"


def _sql_rules() -> tuple[str, str]:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for _, h, p in ordered
    ]
    texts = " ".join(f + f"'{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True))
    verdicts = " ".join(f + f"'{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True))
    return f"CASE {texts} END", f"CASE {verdicts}"


def _sql_level(name: str, own: str, key: str, above: str, parent: str) -> str:
    """Counts of a level with their prior mean, the level's strength and the shrunk mean."""
    return f"""{name}_j AS (SELECT o.*, a.mean AS m FROM {own} o JOIN {above} a USING ({parent})),
  {name}_k AS (SELECT sum(CASE WHEN n > 0 THEN n * (bad / n - m) * (bad / n - m) END) AS s,
    sum(CASE WHEN n > 0 THEN m * (1 - m) END) AS c, sum(CASE WHEN n > 0 THEN n * m * (1 - m) END) AS t FROM {name}_j),
  {name} AS (SELECT j.*, k, (bad + k * m) / (n + k) AS mean FROM {name}_j j, (SELECT coalesce(least(greatest(
    CASE WHEN t > c AND s > c THEN 1 / ((s - c) / (t - c)) - 1 ELSE {hosts.MOST_STRENGTH} END,
    {hosts.LEAST_STRENGTH}), {hosts.MOST_STRENGTH}), {hosts.MOST_STRENGTH}) AS k FROM {name}_k))"""


def _op9_sql() -> str:
    rule, verdict = _sql_rules()
    return f"""WITH p AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
  q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{hosts.UPPER}', '{hosts.LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
  o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality = 1 THEN 0 END) AS bad
    FROM labels GROUP BY doc_id),
  h AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::DOUBLE AS bad, {_sql_suffix("host", 1)} AS domain,
    {_sql_suffix("host", 0)} AS suffix FROM q LEFT JOIN o USING (page_id) GROUP BY host),
  d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
  s AS (SELECT suffix, 0 AS root, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
  r AS (SELECT 0 AS root, (sum(bad) + 0.5) / (sum(n) + 1.0) AS mean FROM s),
  {_sql_level("s2", "s", "suffix", "r", "root")},
  {_sql_level("d2", "d", "domain", "s2", "suffix")},
  {_sql_level("h2", "h", "host", "d2", "domain")},
  z AS (SELECT host, n, bad, mean, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM h2)
SELECT page_id, host, path, {rule} AS rule, {verdict} WHEN greatest(0, mean - {hosts.DEVIATIONS} *
  sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) > {hosts.MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict,
  n AS labelled, bad::BIGINT AS bad_pages FROM q JOIN z USING (host)"""


@query("op9_hosts", _op9_sql())
def op9_hosts(spark, folder):
    """A page's outcome is the label of the same number: bad where it is of low quality or toxic."""
    labels = table(spark, folder, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    pages = table(spark, folder, "pages").select("page_id", "url")
    out = hosts.judge(pages, outcomes, RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "labelled", "bad_pages")


SHARDS, ROW_BYTES = 24, 8


@query("op10_shards")
def op10_shards(spark, folder):
    out = sharding.by_bytes(table(spark, folder, "documents").select("doc_id", "text"), SHARDS, ROW_BYTES)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: SQL for the CRC-32 of a list of bytes, and for the table that it takes.
CRC_TABLE = """SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def _sql_crc(text: str) -> str:
    data = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INT + 1])), 4294967295)"


OP11_SQL = rf"""WITH k AS MATERIALIZED ({CRC_TABLE}),
  o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS no,
    struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS v FROM conversations WHERE conv_id IS NOT NULL),
  a AS MATERIALIZED (SELECT c, list(v ORDER BY no) AS own FROM o GROUP BY c),
  h AS (SELECT a.*, {_sql_crc("a.c::VARCHAR")} % 4 AS h FROM a, k),
  p AS MATERIALIZED (SELECT h.c, list_concat(coalesce(b.own[1:h.h::INT], []), h.own[h.h::INT + 1:]) AS path
    FROM h LEFT JOIN a b ON b.c = h.c - h.c % 20),
  m AS (SELECT c, unnest(range(len(path) + 1)) AS d, path FROM p),
  n AS (SELECT path[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN len(path) = d THEN c::VARCHAR END, ',' ORDER BY c), '') AS ended,
    (count(*) - 1) * coalesce(len(list_filter(string_split_regex(any_value(path)[d].x, '[\x20\x09-\x0D]+'), lambda w: w <> '')), 0) AS saved
    FROM m GROUP BY path[1:d], d),
  c AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
  z AS MATERIALIZED (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN c USING (node, d)),
  u AS (SELECT node[1:i] AS node, i AS d, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT node, saved, n_children, unnest(range(d + 1)) AS i FROM z) GROUP BY node[1:i], i)
SELECT z.conv_id, z.d AS depth, q.conv_id AS parent_conv_id, z.n_convs, z.n_children, u.n_leaves::BIGINT AS n_leaves,
  u.saved_tokens::BIGINT AS saved_tokens, sha256(z.ended) AS ends_sha256
FROM z JOIN u USING (node, d) LEFT JOIN z q ON z.d > 0 AND q.d = z.d - 1 AND q.node = z.node[1:z.d - 1]"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark, folder):
    return prefix_trie.trie(table(spark, folder, "conversations"))


@query("op12_token_counts")
def op12_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.counted(docs, vocabulary(), token_counts.LIMIT, keep=["doc_id"])


def _sql_features(name: str, key: str, source: str) -> str:
    """Features of each text, and how often each bucket occurs in all."""
    words = (
        "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""{name}_w AS (SELECT {key} AS id, {words} AS w FROM {source}),
  {name}_f AS MATERIALIZED (SELECT id, len(w) AS n_words, unnest(list_concat(w, {pairs})) AS f FROM {name}_w),
  {name}_d AS (SELECT f, count(*) AS n FROM {name}_f GROUP BY f),
  {name}_b AS MATERIALIZED (SELECT f, n, {_sql_crc("f")} % {resampling.BUCKETS} AS b FROM {name}_d, k),
  {name}_n AS (SELECT b, sum(n) AS n FROM {name}_b GROUP BY b)"""


OP13_SQL = f"""WITH k AS MATERIALIZED ({CRC_TABLE}),
  {_sql_features("s", "doc_id", "documents")},
  {_sql_features("t", "item_id", "benchmark")},
  g AS (SELECT s_n.b, floor(1000 * ln(((coalesce(t_n.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s_n) + 10000)) /
    ((s_n.n + 1)::DOUBLE * ((SELECT sum(n) FROM t_n) + 10000))))::BIGINT AS gain FROM s_n LEFT JOIN t_n USING (b)),
  w AS (SELECT id, any_value(n_words) AS n_words, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
    FROM s_f JOIN s_b USING (f) JOIN g USING (b) GROUP BY id),
  a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN w ON id = doc_id),
  r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM a WHERE n_words >= {resampling.LEAST_WORDS}
    QUALIFY rank <= {resampling.PERCENT} * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, score, rank FROM a LEFT JOIN r USING (doc_id)"""


@query("op13_resample", OP13_SQL)
def op13_resample(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, folder, "benchmark").select("text"))
