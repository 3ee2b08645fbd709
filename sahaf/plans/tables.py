"""Collection queries over ``documents`` and ``embeddings``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sahaf.plans.registry import query, table
from sahaf.session import scratch_dir
from sahaf.sources import versioned
from sahaf.sources.collection import check_contract, keep_where_not, scan
from sahaf.sources.files import with_embeddings, without_embeddings
from sahaf.sources.rowjson import pack_rows, unpack_rows


def vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))


def collection(spark, folder):
    """Documents with their vectors in the shape of a collection."""
    joined = with_embeddings(table(spark, folder, "documents").select("doc_id", "text", "lang"), vectors(spark, folder))
    return joined.select(F.col("doc_id").cast("string").alias("id"), "text", "lang", "vec")


COLLECTION = """WITH emb AS (SELECT doc_id::VARCHAR AS id, text, lang, embedding AS vec
  FROM documents JOIN embeddings ON vec_id = doc_id) """


@query(
    "docs_with_embeddings",
    """SELECT doc_id, lang, n_chars, len(embedding)::INT AS dim, round(embedding[1]::DOUBLE, 6) AS first
    FROM documents JOIN embeddings ON vec_id = doc_id""",
)
def docs_with_embeddings(spark, folder):
    joined = with_embeddings(table(spark, folder, "documents"), vectors(spark, folder))
    return joined.select(
        "doc_id", "lang", "n_chars", F.size("vec").alias("dim"),
        F.round(F.get("vec", F.lit(0)).cast("double"), 6).alias("first"),
    )


@query(
    "docs_missing_embedding",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def docs_missing_embedding(spark, folder):
    missing = without_embeddings(table(spark, folder, "documents"), vectors(spark, folder))
    return missing.select("doc_id", "lang", "n_chars")


@query("collection_scan", COLLECTION + "SELECT id, text FROM emb WHERE id <> '' AND lang = 'en'")
def collection_scan(spark, folder):
    """Rows by predicate, two columns of them."""
    return scan(collection(spark, folder), "id != '' AND lang = 'en'", ["id", "text"])


@query(
    "delete_where",
    COLLECTION + "SELECT id, lang, len(text) AS n FROM emb WHERE NOT coalesce(lang = 'fr' OR length(text) < 100, false)",
)
def delete_where(spark, folder):
    """What a delete by predicate leaves."""
    kept = keep_where_not(collection(spark, folder), "lang = 'fr' OR length(text) < 100")
    return kept.select("id", "lang", F.length("text").cast("bigint").alias("n"))


GONE = "lang = 'fr' OR length(text) < 100"


@query(
    "snapshot_scan",
    COLLECTION
    + f""", copies AS (SELECT id || '-copy' AS id, text, lang FROM emb WHERE lang = 'de')
    SELECT id, lang, len(text) AS n, 2 AS version FROM emb UNION ALL
    SELECT id, lang, len(text) AS n, 3 AS version FROM emb WHERE NOT coalesce({GONE}, false) UNION ALL
    SELECT id, lang, len(text) AS n, 4 AS version FROM emb WHERE NOT coalesce({GONE}, false) UNION ALL
    SELECT id, lang, len(text) AS n, 4 AS version FROM copies""",
)
def snapshot_scan(spark, folder):
    """A versioned collection after an append, a delete and another append: the rows of each version."""
    place = f"{scratch_dir(spark)}/collection-{uuid.uuid4().hex}"
    rows = collection(spark, folder)
    versioned.create(spark, place, "lang STRING")
    versioned.append(rows, place, 64)
    versioned.delete_where(spark, place, GONE)
    versioned.append(rows.where("lang = 'de'").withColumn("id", F.concat("id", F.lit("-copy"))), place, 64)
    shown = [
        versioned.scan(spark, place, n).select("id", "lang", F.length("text").cast("long").alias("n"), F.lit(n).alias("version"))
        for n in (2, 3, 4)
    ]
    return shown[0].union(shown[1]).union(shown[2])


@query(
    "contract_quarantine",
    """WITH raw AS (SELECT
        CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 11 = 1 THEN repeat('x', 101)
          WHEN doc_id % 3 = 0 THEN 'shared' ELSE doc_id::VARCHAR END AS id,
        CASE WHEN doc_id % 13 = 0 THEN repeat(text, 1 + 65536 // (1 + strlen(text))) || text || text ELSE text END AS text,
        CASE WHEN doc_id % 17 = 0 THEN embedding[1:63] ELSE embedding END AS vec, doc_id
      FROM documents LEFT JOIN embeddings ON vec_id = doc_id)
    SELECT doc_id, CASE WHEN id IS NULL THEN 'id missing' WHEN strlen(id) > 100 THEN 'id too long'
      WHEN strlen(text) > 65535 THEN 'text too long' WHEN vec IS NULL THEN 'vector missing'
      WHEN len(vec) <> 64 THEN 'wrong dimension' WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'id repeated' END AS reason FROM raw""",
)
def contract_quarantine(spark, folder):
    """All documents as rows to insert, many of them damaged, a third sharing one id."""
    n = F.col("doc_id")
    docs = table(spark, folder, "documents").join(vectors(spark, folder), "doc_id", "left")
    long_text = F.concat(
        F.repeat("text", (1 + F.floor(F.lit(65536) / (1 + F.octet_length("text")))).cast("int")), "text", "text"
    )
    raw = docs.select(
        F.when(n % 11 == 0, F.lit(None).cast("string"))
        .when(n % 11 == 1, F.lit("x" * 101))
        .when(n % 3 == 0, F.lit("shared"))
        .otherwise(n.cast("string"))
        .alias("id"),
        F.when(n % 13 == 0, long_text).otherwise(F.col("text")).alias("text"),
        F.when(n % 17 == 0, F.slice("vec", 1, 63)).otherwise(F.col("vec")).alias("vec"),
        "doc_id",
    )
    return check_contract(raw, dim=64).select("doc_id", "reason")


@query("rows_json_roundtrip", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def rows_json_roundtrip(spark, folder):
    """All documents packed into row-wrapped JSON objects and read back."""
    docs = table(spark, folder, "documents")
    rows = unpack_rows(pack_rows(docs, 100), docs.schema)
    return rows.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))
