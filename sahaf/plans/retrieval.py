"""Vector queries over ``embeddings``.

Search texts are stood in for by prototypes: the mean vector of every label, split by
the sign of the first component. Cells are the mean vectors of the labels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.functions import vectors as V
from sahaf.operators.ivf import assign_cells, ivf_search
from sahaf.operators.lsh import fit_lsh, lsh_search
from sahaf.operators.nearest import recall_at_k, score_moments, top_k
from sahaf.operators.pooling import mean_pool
from sahaf.operators.reduce import pca_reduce
from sahaf.operators.search import with_texts
from sahaf.plans.registry import query, table
from sahaf.session import staged

K = 5
NPROBE = 3


def corpus(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )


def prototypes(vectors):
    half = (F.get("vec", F.lit(0)) >= 0).cast("bigint")
    pooled = mean_pool(vectors.select("label", half.alias("half"), "vec"), ["label", "half"])
    return pooled.select((F.col("label") * 2 + F.col("half")).alias("query_id"), F.col("vec").alias("query_vec"))


def cells(vectors):
    return mean_pool(vectors, ["label"]).select(F.col("label").alias("cell"), F.col("vec").alias("centroid"))


def hits(df, *more):
    return df.select("query_id", "rank", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), *more)


PROTOTYPES = """
corpus AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings),
long AS (SELECT label, (vec[1] >= 0)::INT AS half, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos FROM corpus),
pooled AS (SELECT label, half, pos, avg(x) AS x FROM long GROUP BY ALL),
queries AS (SELECT label::BIGINT * 2 + half AS query_id, list(x ORDER BY pos) AS q FROM pooled GROUP BY ALL),
cell_pos AS (SELECT label, pos, avg(x) AS x FROM long GROUP BY ALL),
cells AS (SELECT label AS cell, list(x ORDER BY pos) AS c FROM cell_pos GROUP BY ALL)
"""
L2 = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) ** 2))"
RANKED = """
, ranked AS (SELECT query_id, vec_id, score,
    (row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id))::INT AS rank FROM scored)
"""
IP = "SELECT query_id, vec_id, list_dot_product(q, vec) AS score FROM queries, corpus"


@query(
    "search_ip_topk",
    f"WITH {PROTOTYPES}, scored AS ({IP}) {RANKED.format(order='DESC')}"
    f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= {K}",
)
def search_ip_topk(spark, folder):
    vectors = corpus(spark, folder)
    return hits(top_k(vectors, prototypes(vectors), K, "ip"))


@query(
    "search_cosine_topk",
    f"WITH {PROTOTYPES}, scored AS (SELECT query_id, vec_id, list_cosine_similarity(q, vec) AS score"
    f" FROM queries, corpus) {RANKED.format(order='DESC')}"
    f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= {K}",
)
def search_cosine_topk(spark, folder):
    vectors = corpus(spark, folder)
    return hits(top_k(vectors, prototypes(vectors), K, "cosine"))


@query(
    "search_l2_topk",
    f"WITH {PROTOTYPES}, scored AS (SELECT query_id, vec_id, {L2.format(a='q', b='vec')} AS score"
    f" FROM queries, corpus) {RANKED.format(order='ASC')}"
    f"SELECT query_id, rank, vec_id, round(score, 6) AS score, round(sqrt(score), 6) AS distance"
    f" FROM ranked WHERE rank <= {K}",
)
def search_l2_topk(spark, folder):
    vectors = corpus(spark, folder)
    return hits(top_k(vectors, prototypes(vectors), K, "l2"), F.round(F.sqrt("score"), 6).alias("distance"))


@query(
    "search_hits",
    f"WITH {PROTOTYPES}, scored AS ({IP}) {RANKED.format(order='DESC')}"
    """SELECT query_id, rank, doc_id, round(score, 3) AS score,
      CASE WHEN length(text) > 500 THEN text[1:500] || '...' ELSE text END AS preview
    FROM ranked JOIN documents ON doc_id = vec_id WHERE rank <= 10""",
)
def search_hits(spark, folder):
    """Hits joined to the text of their documents after the ranking."""
    vectors = corpus(spark, folder)
    docs = table(spark, folder, "documents")
    found = top_k(vectors, prototypes(vectors), 10, "ip").withColumnRenamed("id", "doc_id")
    return with_texts(found, docs, "doc_id").select(
        "query_id", "rank", "doc_id", F.round("score", 3).alias("score"), T.preview(F.col("text")).alias("preview")
    )


@query(
    "normalize_vectors",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm,
      round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS first,
      round(v[64] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS last
    FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (label + 1)) AS v FROM embeddings)""",
)
def normalize_vectors(spark, folder):
    """Vectors of uneven length brought to unit length."""
    scaled = corpus(spark, folder).withColumn(
        "v", F.transform(V.to_double(F.col("vec")), lambda x: x * (F.col("label") + 1))
    )
    unit = scaled.select("id", V.norm(F.col("v")).alias("norm"), V.normalize(F.col("v")).alias("u"))
    return unit.select(
        F.col("id").alias("vec_id"),
        F.round("norm", 6).alias("norm"),
        F.round(F.get("u", F.lit(0)), 6).alias("first"),
        F.round(F.get("u", F.lit(63)), 6).alias("last"),
    )


@query(
    "score_stats",
    f"WITH {PROTOTYPES}, scored AS ({IP}) SELECT query_id, count(*) AS n, round(avg(score), 6) AS mean,"
    " round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min, round(max(score), 6) AS max"
    " FROM scored GROUP BY query_id",
)
def score_stats(spark, folder):
    vectors = corpus(spark, folder)
    stats = score_moments(vectors, prototypes(vectors))
    return stats.select("query_id", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max")])


@query(
    "radar_series",
    f"WITH {PROTOTYPES}, scored AS ({IP}) {RANKED.format(order='DESC')}"
    f""", top AS (SELECT * FROM ranked WHERE rank <= {K}),
    spokes AS (SELECT query_id, rank - 1 AS i, rank - 1 AS spoke, vec_id, score FROM top
      UNION ALL SELECT query_id, {K} AS i, 0 AS spoke, vec_id, score FROM top WHERE rank = 1)
    SELECT query_id, i::INT AS i, 'Document: ' || vec_id AS label, round(spoke / {K}.0 * 2 * pi(), 6) AS angle,
      round(score, 6) AS score FROM spokes""",
)
def radar_series(spark, folder):
    """Ranked hits as a closed series: the first spoke comes again at the end."""
    vectors = corpus(spark, folder)
    spoke = F.col("rank") - 1
    points = F.when(spoke == 0, F.array(spoke, F.lit(K))).otherwise(F.array(spoke))
    return top_k(vectors, prototypes(vectors), K, "ip").select(
        "query_id",
        F.explode(points).alias("i"),
        F.concat(F.lit("Document: "), F.col("id")).alias("label"),
        F.round(V.radar_angle(spoke, F.lit(K)), 6).alias("angle"),
        F.round("score", 6).alias("score"),
    )


ASSIGNED = f"""
, near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY {L2.format(a='c', b='vec')}, cell) AS r
   FROM corpus, cells),
assigned AS (SELECT vec_id, cell FROM near WHERE r = 1),
near_q AS (SELECT query_id, cell, row_number() OVER (PARTITION BY query_id ORDER BY {L2.format(a='c', b='q')}, cell) AS r
   FROM queries, cells),
probes AS (SELECT query_id, cell FROM near_q WHERE r <= {NPROBE}),
scored AS (SELECT query_id, vec_id, list_dot_product(q, vec) AS score
   FROM queries JOIN probes USING (query_id) JOIN assigned USING (cell) JOIN corpus USING (vec_id))
"""


@query("ivf_assign", f"WITH {PROTOTYPES} {ASSIGNED} SELECT vec_id, cell::INT AS cell FROM assigned")
def ivf_assign(spark, folder):
    vectors = corpus(spark, folder)
    return assign_cells(vectors, cells(vectors)).select(F.col("id").alias("vec_id"), "cell")


@query(
    "ivf_search",
    f"WITH {PROTOTYPES} {ASSIGNED} {RANKED.format(order='DESC')}"
    f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= {K}",
)
def ivf_search_topk(spark, folder):
    vectors = corpus(spark, folder)
    centroids = staged(cells(vectors), "cells")
    return hits(ivf_search(assign_cells(vectors, centroids), prototypes(vectors), centroids, K, NPROBE))


@query(
    "ann_recall",
    f"WITH {PROTOTYPES} {ASSIGNED} {RANKED.format(order='DESC')}, every AS ({IP}),"
    f"exact AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM every)"
    f"SELECT e.query_id, round(count(a.vec_id) / count(*), 6) AS recall FROM exact e"
    f" LEFT JOIN (SELECT * FROM ranked WHERE rank <= {K}) a ON a.query_id = e.query_id AND a.vec_id = e.vec_id"
    f" WHERE e.r <= {K} GROUP BY e.query_id",
)
def ann_recall(spark, folder):
    vectors = corpus(spark, folder)
    centroids, asked = staged(cells(vectors), "cells"), staged(prototypes(vectors), "prototypes")
    found = ivf_search(assign_cells(vectors, centroids), asked, centroids, K, NPROBE)
    return recall_at_k(found, top_k(vectors, asked, K, "ip")).select("query_id", F.round("recall", 6).alias("recall"))


@query("lsh_search")
def lsh_search_topk(spark, folder):
    vectors = corpus(spark, folder)
    model = fit_lsh(vectors, bucket_length=2.0, tables=3)
    found = lsh_search(model, vectors, prototypes(vectors), K)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.round("distance", 6).alias("distance"))


@query("pca_reduce")
def pca(spark, folder):
    reduced = pca_reduce(corpus(spark, folder), 4)
    return reduced.select(
        F.col("id").alias("vec_id"), *[F.round(F.get("reduced", F.lit(i)), 6).alias(f"c{i + 1}") for i in range(4)]
    )


@query(
    "mean_pool",
    """SELECT label, pos, round(avg(x), 6) + 0.0 AS value FROM
      (SELECT label, unnest(embedding::DOUBLE[]) AS x, (generate_subscripts(embedding, 1) - 1)::INT AS pos FROM embeddings)
    GROUP BY ALL""",
)
def mean_pool_labels(spark, folder):
    pooled = mean_pool(corpus(spark, folder), ["label"])
    return pooled.select("label", F.posexplode("vec").alias("pos", "x")).select(
        "label", "pos", (F.round("x", 6) + F.lit(0.0)).alias("value")
    )
