"""Every registered query against its SQL on the smallest tables, and plan checks."""

import os
import re

import duckdb
import pytest

from sahaf.operators import search
from sahaf.plans import all_queries, all_sql

FOLDER = os.environ.get("SAHAF_TEST_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "embeddings", "pages", "benchmark"]
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def table_rows(frame):
    columns = sorted(frame.columns)
    clean = frame[columns].astype(str).replace({"<NA>": "None", "nan": "None"})
    return columns, sorted(map(tuple, clean.itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = table_rows(QUERIES[name](spark, FOLDER).toPandas())
    want = table_rows(duck.execute(SQL[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_FREE = [
    "html_to_markdown", "convert_errors", "clean_tokens", "sentences", "tokens", "stems", "keyword_ngrams",
    "term_freq", "tfidf", "embed_documents", "extractive_summary", "keywords_per_doc", "citations",
    "mean_pool", "contract_quarantine",
]


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_column_operators_need_no_python_worker(spark, name):
    plan = initial_plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"EvalPython|InArrow|InPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["search_ip_topk", "tfidf_search", "semantic_search", "lsh_search"])
def test_search_limits_before_the_shuffle(spark, name, monkeypatch):
    plans = []
    if name == "semantic_search":
        # The hits are written before their texts are joined: theirs is the plan of the search.
        kept = search.staged
        monkeypatch.setattr(search, "staged", lambda df, what: plans.append(initial_plan(df)) or kept(df, what))
    plan = initial_plan(QUERIES[name](spark, FOLDER))
    if name == "semantic_search":
        assert re.search(r"BroadcastHashJoin.*Build(Left|Right)", plan) and len(plans) == 1
        plan = plans[0]
    assert re.search(r"WindowGroupLimit.*Partial", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_keywords_move_the_text_once(spark):
    """After the documents are placed by id, no statistic needs another shuffle."""
    plan = initial_plan(QUERIES["keywords_per_doc"](spark, FOLDER))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("doc_id")


def test_scan_reads_wanted_columns_only(spark):
    from sahaf.operators.nearest import top_k
    from sahaf.plans.retrieval import prototypes
    from pyspark.sql import functions as F

    corpus = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )
    plan = initial_plan(top_k(corpus, prototypes(corpus), 3))
    assert re.search(r"ReadSchema: struct<vec_id:bigint,embedding:array<float>>", plan)
