"""Cells and buckets over ``embeddings``: k-means by fixed steps, its tree, and multi-probe hashing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sahaf.operators.ivf import assign_cells
from sahaf.operators.kmeans import assign_by_tree, centroid_tree, fit_cells, split_cells, usable
from sahaf.operators.nearest import recall_at_k, top_k
from sahaf.operators.probing import Probing, fit_probing, hash_numbers, probe_search, projections, scored_share
from sahaf.plans.registry import query
from sahaf.plans.retrieval import K, corpus, prototypes
from sahaf.session import staged

NLIST, STEPS, GROUPS, BEAM = 16, 3, 4, 2
#: Shape of the hashes that SQL states: tables, numbers in each, bucket width.
TABLES, BITS, WIDTH = 4, 3, 0.5

CORPUS = "corpus AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings)"


def sql_cells(rows: str, name: str, n: int, steps: int) -> str:
    """CTEs from ``rows(id, vec)`` to the centroids ``name(cell, c)`` and each row's cell ``name_of(id, cell)``."""

    def assigned(k: int) -> str:
        return (
            f"{name}_a{k} AS (SELECT id, arg_min(cell, (list_distance(c, vec), cell)) AS cell FROM {rows}, {name}_{k} GROUP BY id)"
        )

    parts = [
        f"{name}_long AS (SELECT id, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos FROM {rows})",
        f"{name}_0 AS (SELECT row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS cell, vec AS c FROM {rows}"
        f" QUALIFY cell < {n})",
    ]
    for k in range(steps):
        parts += [
            assigned(k),
            f"{name}_p{k} AS (SELECT cell, pos, avg(x) AS x FROM {name}_a{k} JOIN {name}_long USING (id) GROUP BY ALL)",
            f"{name}_m{k} AS (SELECT cell, list(x ORDER BY pos) AS m FROM {name}_p{k} GROUP BY cell)",
            f"{name}_{k + 1} AS MATERIALIZED (SELECT cell, coalesce(m, c) AS c FROM {name}_{k} LEFT JOIN {name}_m{k} USING (cell))",
        ]
    parts += [f"{name} AS (SELECT * FROM {name}_{steps})", assigned(steps).replace(f"{name}_a{steps}", f"{name}_of", 1)]
    return ",\n".join(parts)


@query(
    "ivf_build",
    f"WITH {CORPUS}, {sql_cells('corpus', 'k', NLIST, STEPS)} SELECT cell::INT AS cell, count(id) AS vectors,"
    " any_value(len(c)) AS dim, round(any_value(c[1]), 6) + 0.0 AS first FROM k LEFT JOIN k_of USING (cell) GROUP BY cell",
)
def ivf_build(spark, folder):
    """K-means cells, how many vectors each holds, and where its centroid lies."""
    vectors = corpus(spark, folder).select("id", "vec")
    centroids = fit_cells(vectors, NLIST, STEPS)
    sizes = assign_cells(usable(vectors), centroids).groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"))
    return centroids.join(sizes, "cell", "left").select(
        "cell",
        F.coalesce("vectors", F.lit(0)).alias("vectors"),
        F.size("centroid").alias("dim"),
        (F.round(F.get("centroid", F.lit(0)), 6) + F.lit(0.0)).alias("first"),
    )


@query(
    "ivf_tree",
    f"""WITH {CORPUS}, {sql_cells('corpus', 'k', NLIST, STEPS)},
    nodes AS MATERIALIZED (SELECT cell AS id, c AS vec FROM k),
    {sql_cells('nodes', 'g', GROUPS, STEPS)},
    near AS (SELECT id, g.cell AS grp, row_number() OVER (PARTITION BY id ORDER BY list_distance(c, vec), g.cell) AS r
      FROM corpus, g),
    asked AS (SELECT n.id, vec, o.id AS cell FROM near n JOIN corpus USING (id) JOIN g_of o ON o.cell = grp WHERE r <= {BEAM}),
    found AS (SELECT a.id, arg_min(a.cell, (list_distance(c, vec), a.cell)) AS cell FROM asked a JOIN k USING (cell) GROUP BY a.id)
    SELECT f.id AS vec_id, f.cell::INT AS cell, o.cell::INT AS flat_cell FROM found f JOIN k_of o USING (id)""",
)
def ivf_tree(spark, folder):
    """The cell that each vector finds through the tree of centroids, and its nearest of all."""
    vectors = usable(corpus(spark, folder)).select("id", "vec")
    centroids = fit_cells(vectors, NLIST, STEPS)
    found = assign_by_tree(vectors, centroid_tree(centroids, GROUPS, STEPS), BEAM)
    flat = assign_cells(found.withColumnRenamed("cell", "found"), centroids)
    return flat.select(F.col("id").alias("vec_id"), F.col("found").alias("cell"), F.col("cell").alias("flat_cell"))


@query("ivf_split")
def ivf_split(spark, folder):
    """Cells after those above the mean size were split, and their sizes."""
    vectors = usable(corpus(spark, folder)).select("id", "vec")
    most = -(-vectors.count() // NLIST)
    centroids = split_cells(vectors, fit_cells(vectors, NLIST, STEPS), most)
    sizes = assign_cells(vectors, centroids).groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"))
    return centroids.join(sizes, "cell", "left").select("cell", F.coalesce("vectors", F.lit(0)).alias("vectors"))


def sql_uniform(at: int) -> str:
    """A number above 0 and below 1 from eight digits of the MD5 sum ``h``."""
    return f"((('0x' || substr(h, {at}, 8))::BIGINT + 0.5) / 4294967296.0)"


@query(
    "lsh_hashes",
    f"""WITH {CORPUS}, dims AS (SELECT max(len(vec)) AS dim FROM corpus),
    sums AS (SELECT r, i, dim, md5('0:' || r || ':' || i) AS h
      FROM dims, range({TABLES * BITS}) a(r), range(10000) b(i) WHERE i <= dim),
    planes AS (SELECT r, list(sqrt(-2 * ln({sql_uniform(1)})) * cos(2 * pi() * {sql_uniform(9)}) ORDER BY i)
        FILTER (i < dim) AS a, max({sql_uniform(1)}) FILTER (i = dim) AS shift FROM sums GROUP BY r),
    numbers AS (SELECT id, r, floor(list_dot_product(vec, a) / {WIDTH} + shift)::BIGINT AS n FROM corpus, planes)
    SELECT id AS vec_id, (r // {BITS})::INT AS tbl, string_agg(n::VARCHAR, ',' ORDER BY r) AS numbers
    FROM numbers GROUP BY id, r // {BITS}""",
)
def lsh_hashes(spark, folder):
    """The hash numbers of every vector under projections from MD5 sums."""
    vectors = corpus(spark, folder).select("id", "vec")
    dim = vectors.agg(F.max(F.size("vec"))).first()[0]
    model = Probing(*projections(TABLES * BITS, dim), TABLES, BITS, WIDTH, 1)
    out = hash_numbers(model, vectors)
    return out.select(F.col("id").alias("vec_id"), "tbl", F.array_join(F.col("numbers").cast("array<string>"), ",").alias("numbers"))


@query("lsh_probe")
def lsh_probe(spark, folder):
    """Recall of multi-probe hashing for every prototype, and the share of rows that it scored."""
    vectors, asked = corpus(spark, folder).select("id", "vec"), staged(prototypes(corpus(spark, folder)), "prototypes")
    model = fit_probing(vectors, K)
    recall = recall_at_k(probe_search(model, vectors, asked, K), top_k(vectors, asked, K, "l2"))
    shares = scored_share(model, vectors, asked)
    return recall.join(shares, "query_id").select("query_id", F.round("recall", 6).alias("recall"), F.round("share", 6).alias("share"))
