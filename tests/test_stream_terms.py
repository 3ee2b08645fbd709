"""Frequencies that grow by batches against those of all documents at once."""

import pytest
from pyspark.sql import functions as F

from sahaf.operators.embed import embed_documents
from sahaf.operators.terms import fit_terms
from sahaf.sources import versions
from sahaf.streaming import incremental, terms


def rows_of(model):
    return {(r.term, r.df, round(r.idf, 9)) for r in model.table.collect()}


@pytest.fixture
def docs(spark):
    rows = [(i, f"word{'abcde'[i % 5]} shared {'rare' if i == 7 else 'plain'} text") for i in range(40)] + [(50, None), (51, ""), (None, "of no document")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def parts(docs, n):
    key = F.coalesce(F.col("doc_id"), F.lit(0))
    return [docs.where(key % n == i) for i in range(n)]


def test_batches_equal_all_at_once(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(terms, "MOST_DELTAS", 3)
    folder, at = str(tmp_path / "t"), {}
    for i, part in enumerate(parts(docs, 5)):
        at[i] = terms.update_terms(part, folder, i)
    assert rows_of(terms.terms(spark, folder)) == rows_of(fit_terms(docs))
    first = parts(docs, 5)[0]
    assert rows_of(terms.terms(spark, folder, at[0])) == rows_of(fit_terms(first)), "a snapshot stays"
    assert len(versions.read(spark, folder)[1]["deltas"]) <= 3


def test_a_replayed_batch_changes_nothing(spark, docs, tmp_path):
    folder = str(tmp_path / "t")
    one, two = parts(docs, 2)
    terms.update_terms(one, folder, 0)
    number = terms.update_terms(two, folder, 1)
    assert terms.update_terms(two, folder, 1) == terms.update_terms(one, folder, 0) == number
    assert rows_of(terms.terms(spark, folder)) == rows_of(fit_terms(docs))


def test_two_writers_of_one_batch(spark, docs, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    one, two = parts(docs, 2)
    old = terms._state(spark, folder)
    terms.update_terms(one, folder, 0)
    monkeypatch.setattr(terms, "_state", lambda *_: old)
    with pytest.raises(versions.Conflict):
        terms.update_terms(two, folder, 0)
    monkeypatch.undo()
    assert rows_of(terms.terms(spark, folder)) == rows_of(fit_terms(one))


def test_the_built_in_embedding_in_a_stream(spark, docs, tmp_path):
    folder, source = str(tmp_path / "t"), tmp_path / "in"
    known = docs.where("text <> '' AND doc_id IS NOT NULL")
    terms.update_terms(known, folder, 0)
    source.mkdir()
    for r in known.limit(6).collect():
        (source / f"{r.doc_id}.md").write_text(r.text)
    query = incremental.stream_embedding(
        spark, str(source), str(tmp_path / "out"), str(tmp_path / "ck"), terms.embed_in_batches(folder, 16), 16, files_per_batch=2
    )
    query.awaitTermination()
    got = {r.id: r.vec for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {str(r.doc_id): r.vec for r in embed_documents(known, 16).collect()}
    assert len(got) == 6 and all(sum(abs(a - b) for a, b in zip(v, want[k], strict=True)) < 1e-4 for k, v in got.items())
