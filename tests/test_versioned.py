"""Versioned collections: commits, deletes without rewriting, key checks and old versions."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sahaf.sources import versioned as C
from sahaf.sources import versions


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "c")
    assert C.create(spark, path, "lang STRING") == 1
    return path


def rows(spark, ids, lang="en"):
    return spark.createDataFrame([(str(i) if i is not None else None, f"text {i}", [1.0, 2.0], lang) for i in ids], "id string, text string, vec array<float>, lang string")


def ids(df):
    return sorted(r.id for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_append_delete_and_old_versions(spark, folder):
    assert C.scan(spark, folder).count() == 0
    assert C.append(rows(spark, range(10, 30)), folder, 2).count() == 0
    before = files(f"{folder}/data")
    assert C.delete_where(spark, folder, "id = '12' OR lang = 'fr'") == 1
    assert files(f"{folder}/data") == before, "a delete writes no data file"
    assert C.delete_where(spark, folder, "lang IS NULL OR NULL") == 0
    assert ids(C.scan(spark, folder)) == [str(i) for i in range(10, 30) if i != 12]
    assert len(ids(C.scan(spark, folder, 2))) == 20 and C.scan(spark, folder, 1).count() == 0
    assert versions.numbers(spark, folder) == [1, 2, 3]
    assert C.delete_where(spark, folder, F.col("id") > "25") == 4
    assert C.append(rows(spark, [12, 27]), folder, 2).count() == 0, "a deleted id may come again"
    assert ids(C.scan(spark, folder)) == sorted(str(i) for i in [*range(10, 26), 27])


def test_contract_of_appends(spark, folder):
    C.append(rows(spark, range(10, 20)), folder, 2)
    bad = C.append(rows(spark, [15, 31, 32, 32, None]), folder, 2)
    assert Counter((r.id, r.reason) for r in bad.collect()) == {("15", "id exists"): 1, ("32", "id repeated"): 2, (None, "id missing"): 1}
    assert len(ids(C.scan(spark, folder))) == 11
    with pytest.raises(ValueError):
        C.append(rows(spark, [1]).withColumn("year", F.lit(1)), folder, 2)
    number = versions.numbers(spark, folder)[-1]
    C.append(rows(spark, [15]), folder, 2)
    assert versions.numbers(spark, folder)[-1] == number, "nothing good, nothing committed"


def test_keys_are_read_only_where_the_ids_may_be(spark, folder):
    C.append(rows(spark, range(1000, 1400)), folder, 2)
    C.append(rows(spark, range(5000, 5400)), folder, 2)
    _, content = versions.read(spark, folder)
    fresh = rows(spark, [5001, 5002, 6000])
    known = C._known(spark, folder, content, fresh)
    read = {r[0] for r in known.select(F.input_file_name()).distinct().collect()}
    assert 1 <= len(read) <= 3 and all(content["keys"][1]["name"] in f for f in read)
    assert {"5001", "5002"} <= set(ids(known)) and known.count() < 40
    assert C._known(spark, folder, content, rows(spark, [7000])) is None


def test_a_concurrent_commit_is_refused(spark, folder, monkeypatch):
    C.append(rows(spark, [1]), folder, 2)
    old = versions.read(spark, folder)
    C.append(rows(spark, [2]), folder, 2)
    monkeypatch.setattr(C.versions, "read", lambda *_: old)
    with pytest.raises(versions.Conflict):
        C.append(rows(spark, [2]), folder, 2)
    with pytest.raises(versions.Conflict):
        C.delete_where(spark, folder, "id = '1'")
    monkeypatch.undo()
    assert ids(C.scan(spark, folder)) == ["1", "2"]
    with pytest.raises(versions.Conflict):
        C.create(spark, folder)


def test_compact_and_vacuum(spark, folder):
    for part in (range(10, 14), range(14, 18)):
        C.append(rows(spark, part), folder, 2)
    C.delete_where(spark, folder, "id IN ('11', '15')")
    number = C.compact(spark, folder)
    _, content = versions.read(spark, folder)
    assert not content["deletes"] and len(content["data"]) == len(content["keys"]) == 1
    assert ids(C.scan(spark, folder)) == ids(C.scan(spark, folder, number - 1)) == ["10", "12", "13", "14", "16", "17"]
    assert len(C.vacuum(spark, folder)) >= 5 and versions.numbers(spark, folder) == [number]
    assert len(ids(C.scan(spark, folder))) == 6
    assert C.append(rows(spark, [11, 12]), folder, 2).count() == 1
    C.delete_where(spark, folder, "true")
    C.compact(spark, folder)
    assert C.scan(spark, folder).count() == 0
