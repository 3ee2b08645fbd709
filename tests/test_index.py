"""The kept term index against the search that reads the corpus, and against plain sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.operators import index
from sahaf.operators.terms import tfidf_search
from sahaf.sources import versions


def corpus(rng, n):
    common = [f"c{chr(97 + i)}" for i in range(6)]
    rare = [f"r{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    texts = [" ".join([*rng.choice(common, 8), *rng.choice(rare, 4)]) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(n, None), (n + 1, ""), (n + 2, texts[0]), (n + 3, texts[0]), (None, texts[1]), (n + 4, "12 34")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "x") for r in corpus(np.random.default_rng(2), 700)]
    return spark.createDataFrame(rows, "doc_id long, text string, term string").repartition(4)


@pytest.fixture(scope="module")
def asked(spark, docs):
    texts = [r.text for r in docs.where("doc_id < 12").collect()] + ["ca", "unknown words", None, "", "raa rab rac raa ca", "ca"]
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "query_id string, text string")


def hits(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("shard_docs, slice_terms", [(20_000, 50_000), (90, 50_000), (300, 20)])
def test_index_search_equals_tfidf_search(spark, docs, asked, tmp_path, monkeypatch, shard_docs, slice_terms):
    monkeypatch.setattr(index, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(index, "SLICE_TERMS", slice_terms)
    folder = str(tmp_path / "i")
    index.add_segment(docs.where("doc_id % 2 = 0 OR doc_id IS NULL"), folder)
    index.add_segment(docs.where("doc_id % 2 = 1"), folder)
    assert index.publish(spark, folder) == 1
    for k in (1, 7):
        assert hits(index.index_search(spark, folder, asked, k)) == hits(tfidf_search(docs, asked, k))


def test_versions_of_an_index(spark, docs, asked, tmp_path, monkeypatch):
    folder = str(tmp_path / "i")
    with pytest.raises(FileNotFoundError):
        index.publish(spark, folder)
    half = docs.where("doc_id < 300")
    index.add_segment(half, folder)
    index.publish(spark, folder)
    index.add_segment(docs.where("doc_id >= 300"), folder)
    assert hits(index.index_search(spark, folder, asked, 5)) == hits(tfidf_search(half, asked, 5)), "not before it is published"
    index.publish(spark, folder)
    assert hits(index.index_search(spark, folder, asked, 5)) == hits(tfidf_search(docs.where("doc_id IS NOT NULL"), asked, 5))
    assert hits(index.index_search(spark, folder, asked, 5, version=1)) == hits(tfidf_search(half, asked, 5))
    monkeypatch.setattr(index.versions, "numbers", lambda *_: [1])
    with pytest.raises(versions.Conflict):
        index.publish(spark, folder)


def test_a_search_reads_the_index_only(spark, docs, asked, tmp_path):
    folder = str(tmp_path / "i")
    index.add_segment(docs, folder)
    index.publish(spark, folder)
    found = index.index_search(spark, folder, asked.limit(1), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "CartesianProduct" not in plan
    assert "PartitionFilters: [bucket" in plan or "bucket#" in plan
    assert not [f for f in found.inputFiles() if "/segments/" in f]
    none = index.index_search(spark, folder, asked.where("false"), 3)
    assert none.count() == 0


def shard_of(rng, docs, terms):
    """A shard with one rare, heavy stretch for each term, and its dense matrix."""
    dense = np.zeros((terms, docs))
    for t in range(terms):
        some = rng.random(docs) < 0.4
        dense[t, some] = rng.random(int(some.sum())) * 0.1
        at = int(rng.integers(0, docs - 50))
        dense[t, at : at + 50] += 0.8
    names, first, top, sizes, nos, shares = [], [], [], [], [], []
    for t in range(terms):
        own = np.flatnonzero(dense[t])
        for i in range(0, len(own), index.BLOCK):
            part = own[i : i + index.BLOCK]
            names.append(f"t{t:02}")
            first.append(part[0]), top.append(dense[t, part].max()), sizes.append(len(part))
            nos.append(part), shares.append(dense[t, part])
    arrays = [np.array(x) for x in (first, top, sizes)]
    return dense, index.Shard(names, *arrays, np.concatenate(nos).astype(np.int32), np.concatenate(shares))


def test_stretches_that_cannot_reach_are_left_out():
    rng = np.random.default_rng(3)
    dense, shard = shard_of(rng, 20_000, 12)
    for k in (1, 5, 40):
        for _ in range(15):
            terms = rng.choice(12, int(rng.integers(1, 5)), replace=False)
            weights = rng.random(len(terms)) + 0.1
            shard.scored = 0
            no, score = shard.search([(f"t{t:02}", w) for t, w in zip(terms, weights, strict=True)] + [("none", 1.0)], k)
            want = np.round(weights @ dense[terms], 10)
            best = np.lexsort((np.arange(len(want)), -want))[:k]
            order = np.lexsort((no, -score))[:k]
            assert no[order].tolist() == best.tolist() and np.allclose(score[order], want[best], atol=1e-9)
            assert shard.scored < shard.stretches / 2
    assert len(shard.search([("none", 1.0)], 3)[0]) == 0


def test_tokenising_happens_once(spark, docs, asked, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "i"), []
    index.add_segment(docs, folder)
    kept = index.term_counts
    monkeypatch.setattr(index, "term_counts", lambda df, mode: seen.append(df.columns) or kept(df, mode))
    index.publish(spark, folder)
    assert not seen, "publishing reads counts, no texts"
    index.index_search(spark, folder, asked, 3).count()
    assert len(seen) == 1, "only the queries are tokenised"
    assert spark.read.parquet(f"{folder}/index/*/terms").where(F.col("df") < 1).count() == 0


def test_publishing_moves_counts_once(spark, docs, asked, tmp_path, monkeypatch):
    """Neither segments of different documents are merged, nor postings moved; documents in parts are merged."""
    writes, staged = [], []
    writer, kept = type(docs.write), (type(docs.write).parquet, index.staged)

    def parquet(self, path, *args, **more):
        if path.endswith("/blocks"):
            writes.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return kept[0](self, path, *args, **more)

    monkeypatch.setattr(writer, "parquet", parquet)
    monkeypatch.setattr(index, "staged", lambda df, name: staged.append(name) or kept[1](df, name))
    apart, parts = str(tmp_path / "a"), str(tmp_path / "p")
    for part in (docs.where("doc_id < 300"), docs.where("doc_id >= 300")):
        index.add_segment(part, apart)
    index.publish(spark, apart)
    assert staged == ["ids"] and len(writes) == 1
    last = writes[0][: writes[0].index("Union")]
    assert last.count("RepartitionByExpression") == 1 and "bucket" in last
    for text in (F.substring_index("text", " ", 5), F.substring_index("text", " ", -7)):  # twelve words
        index.add_segment(docs.where("doc_id < 700").withColumn("text", text), parts)
    index.publish(spark, parts)
    assert staged == ["ids", "counts", "ids"]
    df = spark.read.parquet(f"{parts}/index/*/terms").select("term", "df")
    want = index.term_counts(docs.where("doc_id < 700")).groupBy("term").count()
    assert {tuple(r) for r in df.collect()} == {tuple(r) for r in want.collect()}
