import json

import pytest
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.operators.embed import embed_with
from sahaf.sources import collection as C
from sahaf.sources import files, rowjson
from sahaf.streaming.incremental import stream_conversion, stream_embedding


@pytest.fixture
def table(spark):
    name = "emb_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    C.create_collection(spark, name)
    yield name
    spark.catalog.clearCache()
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, values):
    return spark.createDataFrame(values, "id string, text string, vec array<float>")


def test_append_scan_delete(spark, table):
    C.create_collection(spark, table)  # a second time changes nothing
    assert C.collection_exists(spark, table) and table in C.list_collections(spark)
    good = [("a", "x", [3.0, 4.0]), ("b", None, [0.0, 0.0]), ("", "e", [1.0, 0.0])]
    bad = [
        (None, "t", [1.0, 0.0]),
        ("i" * 101, "t", [1.0, 0.0]),
        ("ş" * 51, "t", [1.0, 0.0]),
        ("long", "ü" * 32768, [1.0, 0.0]),
        ("none", "t", None),
        ("dim", "t", [1.0]),
        ("twice", "t", [1.0, 0.0]),
        ("twice", "t", [1.0, 0.0]),
    ]
    rejected = C.append(rows(spark, good + bad), table, dim=2)
    assert sorted(r.reason for r in rejected.collect()) == sorted(
        ["id missing", "id too long", "id too long", "text too long", "vector missing", "wrong dimension"]
        + ["id repeated"] * 2
    )
    stored = {r.id: r.vec for r in spark.table(table).collect()}
    assert stored == {"a": pytest.approx([0.6, 0.8]), "b": [0.0, 0.0], "": [1.0, 0.0]}
    again = C.append(rows(spark, good[:1]), table, dim=2).collect()
    assert [r.reason for r in again] == ["id exists"] and spark.table(table).count() == 3
    assert C.append(rows(spark, []), table, dim=2).count() == 0

    found = C.scan(spark.table(table), "id != ''", ["id"]).collect()
    assert sorted(r.id for r in found) == ["a", "b"]
    assert C.load_collection(spark, table).count() == 3
    spark.catalog.uncacheTable(table)
    C.delete_where(spark, table, "text = 'x'")  # null text: unknown, kept
    assert sorted(r.id for r in spark.table(table).collect()) == ["", "b"]


def test_bulk_insert_both_formats(spark, table, tmp_path):
    rows(spark, [("p", "t", [1.0, 0.0])]).write.parquet(str(tmp_path / "p"))
    rowjson.write_row_json(rows(spark, [("j", None, [0.0, 2.0])]), str(tmp_path / "j"))
    C.bulk_insert(spark, str(tmp_path / "p"), table, dim=2)
    C.bulk_insert(spark, str(tmp_path / "j"), table, "json", dim=2)
    assert {r.id: r.vec for r in spark.table(table).collect()} == {"p": [1.0, 0.0], "j": [0.0, 1.0]}


def test_auto_id(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    assert C.with_auto_id(df).select("id").distinct().count() == 3
    assert C.with_auto_id(df, reproducible=True).select("id").distinct().count() == 2


def test_books_as_row_json(spark, tmp_path):
    books = [(100 + i, 10 * i, [i / 10, i / 5]) for i in range(5)]
    df = spark.createDataFrame(books, "book_id int, word_count int, book_intro array<double>").coalesce(1)
    rowjson.write_row_json(df, str(tmp_path / "books"), rows_per_object=2)
    raw = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "books")).collect()]
    assert sorted(len(o["rows"]) for o in raw) == [1, 2, 2]
    back = rowjson.read_row_json(spark, str(tmp_path / "books"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "one.json").write_text(json.dumps({"rows": [{"a": 1}, {"a": 2}]}, indent=1))
    assert sorted(r.a for r in rowjson.read_row_json(spark, str(tmp_path / "one.json")).collect()) == [1, 2]


def envelope(path, data):
    path.write_text(json.dumps({"data": data, "metadata": {"FMTY": "SUCCESS", "PTID": None}}), encoding="utf-8")


def test_envelopes_to_markdown(spark, tmp_path):
    envelope(tmp_path / "1.json", "<html><body><b>Karar</b><p>Dava dilekçesi</p></body></html>")
    envelope(tmp_path / "2.json", None)
    envelope(tmp_path / "3.json", "  ")
    (tmp_path / "4.json").write_text("{not json")
    (tmp_path / "skip.txt").write_text("x")
    read = files.read_envelopes(spark, str(tmp_path))
    assert read.where("doc_id = '1'").first().metadata.FMTY == "SUCCESS"
    out = {r.doc_id: r for r in files.convert_envelopes(read).collect()}
    assert out["1"].markdown == "**Karar**\n\nDava dilekçesi" and out["1"].error is None
    assert {i: out[i].error for i in "234"} == {"2": "no data", "3": "empty data", "4": "not a JSON envelope"}
    assert all((r.markdown is None) != (r.error is None) for r in out.values())
    assert [r.doc_id for r in files.list_files(spark, str(tmp_path), ".json").collect()] == list("1234")
    files.write_markdown_files(files.convert_envelopes(read), str(tmp_path / "md"))
    exported = list((tmp_path / "md").glob("doc_id=1/*.txt"))
    assert exported[0].read_text(encoding="utf-8").strip() == out["1"].markdown


def test_markdown_and_embedding_files(spark, tmp_path):
    for i in (1, 2, 3):
        (tmp_path / f"{i}.md").write_text(f"# {i}\n\nMetin", encoding="utf-8")
    (tmp_path / "emb").mkdir()
    (tmp_path / "emb" / "a.json").write_text(json.dumps({"1": [0.1, 0.2], "9": [1, 2]}))
    (tmp_path / "emb" / "b.json").write_text(json.dumps({"2": None}))
    docs = files.read_markdown(spark, str(tmp_path))
    assert docs.where("doc_id = '1'").first().text == "# 1\n\nMetin"
    emb = files.read_embedding_files(spark, str(tmp_path / "emb"))
    assert [r.doc_id for r in files.with_embeddings(docs, emb).collect()] == ["1"]
    assert sorted(r.doc_id for r in files.without_embeddings(docs, emb).collect()) == ["2", "3"]


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('t1,n\n"Hello, World",3\n')
    row = files.read_csv(spark, str(tmp_path / "t.csv")).withColumn("w", T.words(F.col("t1"))).first()
    assert (row.w, row.n) == (["hello", "world"], 3)


def test_incremental_conversion(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    for i in range(4):
        envelope(source / f"{i}.json", f"<p>{i}</p>")

    def run():
        query = stream_conversion(spark, str(source), target, state, files_per_batch=2)
        query.awaitTermination()
        return [p.batchId for p in query.recentProgress if p.numInputRows]

    assert len(run()) == 2
    assert run() == []
    envelope(source / "4.json", None)
    run()
    got = {r.doc_id: (r.markdown, r.error) for r in spark.read.parquet(target).collect()}
    assert got == {**{str(i): (str(i), None) for i in range(4)}, "4": (None, "no data")}


def test_incremental_embedding(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    model = lambda: lambda texts: [[float(len(t)), 1.0] for t in texts]

    def run():
        query = stream_embedding(
            spark, str(source), target, state, lambda df: embed_with(df, model), dim=2, files_per_batch=2
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    for i in range(3):
        (source / f"{i}.md").write_text("x" * (i + 1))
    run()
    run()
    (source / "3.md").write_text("new")
    (source / "sub").mkdir()
    run()
    stored = spark.read.parquet(target)
    assert sorted(r.id for r in stored.collect()) == ["0", "1", "2", "3"]
    (source / "3.markdown.md").write_text("other id")
    run()
    assert spark.read.parquet(target).count() == 5


def test_callers_columns_are_kept(spark):
    name = "with_columns"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    C.create_collection(spark, name, "lang STRING, year INT")
    some = spark.createDataFrame([("a", "t", [3.0, 4.0], "tr"), (None, "u", [1.0, 0.0], "de")], "id string, text string, vec array<float>, lang string")
    rejected = C.append(some, name, dim=2)
    assert [(r.lang, r.reason) for r in rejected.collect()] == [("de", "id missing")]
    got = spark.table(name).first()
    assert (got.id, got.lang, got.year) == ("a", "tr", None) and got.vec == pytest.approx([0.6, 0.8])
    with pytest.raises(ValueError, match="source"):
        C.append(some.withColumn("source", F.lit("x")), name, dim=2)


def test_segments_are_matched_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, x string").write.parquet(str(tmp_path / "1"))
    spark.createDataFrame([("b", 2)], "y string, id long").write.parquet(str(tmp_path / "2"))
    out = C.read_segments(spark, [str(tmp_path / "1"), str(tmp_path / "2")])
    assert {(r.id, r.x, r.y) for r in out.collect()} == {(1, "a", None), (2, None, "b")}
