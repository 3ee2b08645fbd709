"""Extra columns with clashing names, rows decided one by one, vectors of several lengths, and recall of the code tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.llm import hosts, itq, lines, quality, stages
from sahaf.llm.registry import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def words(rng, n):
    return " ".join(f"w{x}" for x in rng.integers(0, 3000, n))


def test_hosts_keep_clashing_columns(spark):
    names = ["bound", "posterior", "row", "domain", "suffix", "n", "mean", "strength", "rule"]
    rows = [(i, f"http://h{i % 3}.org/{i}", *["x"] * len(names)) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, " + ", ".join(f"`{n}` string" for n in names))
    out = hosts.judge(df, spark.createDataFrame([(0, 1)], "page_id long, bad int"), [])
    added = {"bound", "posterior", "rule"}
    assert {c for c in names if c not in added} <= set(out.columns) and len(out.columns) == len(set(out.columns))
    assert all(r["row"] == "x" and r["domain"] == "x" and r["bound"] != "x" for r in out.collect()) and out.count() == 9


@pytest.mark.parametrize(
    "host, domain, suffix",
    [
        ("10.0.0.1:8080", "10.0.0.1", "10.0.0.1"), ("[2001:db8::1]:80", "[2001:db8::1]", "[2001:db8::1]"),
        ("user:pw@a.b.co.uk:99", "b.co.uk", "co.uk"), ("a.b.org", "b.org", "org"), ("localhost", "localhost", "localhost"), ("", "", ""),
    ],
)
def test_domains(spark, host, domain, suffix):
    h = spark.range(1).select(F.lit(host).alias("h"))
    assert tuple(h.select(hosts.domain(F.col("h")), hosts.suffix(F.col("h"))).first()) == (domain, suffix)


def test_a_suffix_list_is_a_parameter(spark):
    h = spark.range(1).select(F.lit("a.b.c.d").alias("h"))
    assert h.select(hosts.domain(F.col("h"), ["c.d"])).first()[0] == "b.c.d"


def test_lines_keep_clashing_columns(spark):
    rng = np.random.default_rng(1)
    one, two = words(rng, 12), words(rng, 12)
    rows = [(1, f"{one}\n{two}", "a", "b", "c", "d"), (2, f"{one}\nnew line here", "a", "b", "c", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `_nos` string, `_dkey` string, dkey string, nos string")
    out = {r.doc_id: r for r in lines.without_repeats(df).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "new line here" and tuple(out[2])[2:] == ("a", "b", "c", "d")


def test_quality_keeps_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, words(rng, 30), "en", "a", "b", "c", "d") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, `_lang` string, `_dkey` string, dkey string, keep string")
    out = quality.classify(df, df.where("doc_id < 30").select("doc_id"))
    assert out.count() == 40 and dict(out.dtypes)["keep"] == "boolean"
    assert {(r["_lang"], r["_dkey"], r["dkey"]) for r in out.collect()} == {("a", "b", "c")}


def test_join_stage_decides_row_by_row(spark):
    rng = np.random.default_rng(3)
    a, b, c = (words(rng, 40) for _ in range(3))
    rows = [(7, a, "x"), (3, a + " tail", "x"), (3, b, "x"), (9, b, "x"), (None, c, "x"), (None, c, "x"), (None, None, "x"), (None, None, "x"), (5, "", "x"), (3, b, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, no string").repartition(3)
    out = sorted(((r.doc_id, r.text, r.no) for r in stages.ngram_join(spark, df, "").collect()), key=repr)
    want = [(3, a + " tail", "x"), (3, b, "x"), (None, c, "x"), (None, None, "x"), (None, None, "x"), (5, "", "x")]
    assert out == sorted(want, key=repr)
    assert stages.ngram_join(spark, df.limit(0), "").count() == 0


@pytest.mark.parametrize("mean", [0.0, 1.0])
@pytest.mark.parametrize("largest", [5_000, 100_000, 2_000_000, 30_000_000])
def test_pairs_at_the_threshold_meet(mean, largest):
    rng = np.random.default_rng(4)
    x = itq.unit(rng.standard_normal((6_000, 64)) + mean)
    sample = itq.spread_out(x[:4_000])
    bits, tables, model = itq.layout(largest, 0.93, sample)
    own = x[4_000:]
    away = rng.standard_normal(own.shape)
    away = itq.unit(away - (away * own).sum(axis=1, keepdims=True) * own)
    cosine = rng.uniform(0.93, 0.95, (len(own), 1))
    partner = cosine * own + np.sqrt(1 - cosine**2) * away
    met = (itq.keys_of(own, model, bits, tables) == itq.keys_of(partner, model, bits, tables)).any(axis=1)
    assert bits >= itq.LEAST_BITS and met.mean() >= 0.95


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for length, start in ((8, 0), (16, 100), (1, 200)):
        base = rng.standard_normal((30, length))
        for i in range(30):
            copy = i - i % 3
            vec = base[copy] * (1 + i) if i % 3 else base[i]
            rows.append((start + i, [float(v) for v in vec], 1))
    vectors = {r[0]: itq.unit(np.array([r[1]], np.float32))[0] for r in rows}
    root = {i: i for i in vectors}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = dict.fromkeys(vectors, 0)
    for i, u in vectors.items():
        for j, v in vectors.items():
            if i < j and len(u) == len(v) and u @ v >= 0.93:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 8, 1), (503, rows[0][1], None)]
    want = {i: (links[i], find(i)) for i in vectors} | {i: (0, i) for i in range(500, 504)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()} == want
