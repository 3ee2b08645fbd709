"""The pipeline's stages on the smallest tables, and the registered queries against their SQL."""

import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from sahaf.llm import QUERIES, SQL, ngram_join, quality
from sahaf.llm.queries import trusted_ids

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, FOLDER)
    columns = got.columns
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_every_query_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(path := str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(path)
        rows[i] = docs.count()
        if i < 4:
            assert docs.columns == columns, name
        if i == 0:
            kept = quality.classify(before, trusted_ids(spark, FOLDER)).where("keep").count()
            assert rows[0] == kept < before.count()
        if i == 1:
            assert rows[1] == rows[0]
        if i == 2:
            groups = ngram_join.similar_groups(before).select("component_id").distinct().count()
            assert rows[2] == groups
    assert rows[4] > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, FOLDER).count() == rows[4]


def test_stages_equal_a_plain_version(spark, tmp_path, monkeypatch):
    """Each stage's rows, on the rows it got, from plain Python: keep, line cuts, groups, words taken, pieces."""
    import math
    from collections import Counter

    from sahaf.llm import packing
    from sahaf.llm.queries import EPOCHS, SHARE, WEIGHTS, vocabulary
    from tests.llm.test_operators import brute_groups, brute_lines, words_of

    rng = np.random.default_rng(9)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    notice = prose(14)
    rows = []
    for i in range(80):
        text = f"{prose(20)}\n{notice}\n{prose(12)}" if i % 4 == 0 else prose(int(rng.integers(8, 70)))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(100 + i, rows[i][1] + (" end" if i % 2 else ""), "en", "s0", 1) for i in range(12)]
    rows += [(200 + i, "".join(chr(int(c)) for c in rng.integers(97, 123, 300)), "en", "s1", 1) for i in range(4)]
    rows += [(300, None, "fr", None, 0), (301, "", None, "s2", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    folder = str(tmp_path)

    docs, got = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        got.append([r.asDict() for r in docs.collect()])
    # 1: noise goes, clean documents stay, by the limit that the operator states.
    left = {r["doc_id"] for r in got[0]}
    assert not left & set(range(200, 204)) and {300, 301} <= left and len(left & set(range(80))) >= 78
    # 2: lines as by brute force on what stage 1 kept.
    gone = brute_lines([(r["doc_id"], r["text"]) for r in got[0]])
    assert len(gone) > 20
    cut = Counter()
    for r in got[0]:
        own = gone.get((r["doc_id"], r["text"]))
        cut[r["doc_id"], "\n".join(x for n, x in enumerate(r["text"].split("\n")) if n not in own) if own else r["text"]] += 1
    assert Counter((r["doc_id"], r["text"]) for r in got[1]) == cut
    # 3: the smallest id of each group.
    groups = brute_groups([(r["doc_id"], r["text"]) for r in got[1]])
    assert sorted(r["doc_id"] for r in got[2]) == sorted({root for _, _, root in groups})
    # 4: each source's words meet its target, no document is taken more than twice.
    size = {r["doc_id"]: len(words_of(r["text"])) for r in got[2]}
    source = {r["doc_id"]: r["source"] for r in got[2]}
    sums, names = Counter(), sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    for d, n in size.items():
        sums[source[d]] += n
    limit = {s: EPOCHS * sums[s] for s in names}
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    low, high = 0.0, 10.0 * sum(sums.values())
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(weight[s] * level, limit[s]) for s in names) < SHARE * sum(sums.values()) else (low, level)
    taken, by = Counter(), Counter()
    for r in got[3]:
        taken[r["doc_id"]] += len(words_of(r["text"]))
        by[r["source"]] += len(words_of(r["text"]))
    assert all(abs(by[s] - min(weight[s] * high, limit[s])) <= 1 for s in names)
    assert all(n <= EPOCHS * size[d] for d, n in taken.items())
    # 5: the tokens of every row in pieces, gapless in sequences.
    tokenizer = packing.encoder(vocabulary()).tokenizer
    wanted = Counter()
    for r in got[3]:
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        wanted.update((r["doc_id"], i, min(packing.LENGTH, n - i * packing.LENGTH)) for i in range(math.ceil(n / packing.LENGTH)))
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in got[4]) == wanted
    places = {}
    for r in got[4]:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert sum(spans[-1]) <= packing.LENGTH
