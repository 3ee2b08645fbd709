import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sahaf.operators.embed import embed_documents, embed_texts, embed_with
from sahaf.operators.keywords import as_annotations, corpus_keywords, extract_keywords
from sahaf.operators.skew import join_frequent_first
from sahaf.operators.graph import graph_summaries, sentence_entries, sentence_ranks
from sahaf.operators.summarize import control_pairs, pair_cosine, summarize, summary_report
from sahaf.operators.terms import fit_hashed_tfidf, fit_terms, term_counts, tfidf, tfidf_search

TEXTS = {
    1: ("en", "The cat sat on the mat. The dog sat on the cat!"),
    2: ("en", "Dogs and cats are animals. Animals sleep."),
    3: ("fr", "Le chat dort sur le tapis."),
    4: ("en", "The cat sat on the mat. The dog sat on the cat!"),
    5: ("fr", "..."),
    6: ("de", "Der Hund und die Katze schlafen."),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, lang, text) for i, (lang, text) in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string").cache()


def words(text):
    return re.sub(r"[^\w\s]|\d|_", "", text).lower().split()


def weights():
    counts = {i: Counter(words(t)) for i, (_, t) in TEXTS.items()}
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((len(TEXTS) + 1) / (n + 1)) for w, n in df.items()}
    return counts, idf


def test_tfidf(docs):
    counts, idf = weights()
    got = {(r.doc_id, r.term): (r.tf, r.weight) for r in tfidf(docs).collect()}
    want = {(i, w): (n, n * idf[w]) for i, c in counts.items() for w, n in c.items()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_frequent_keys_join_like_a_plain_left_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        "id",
    )
    right = left.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).where("key != 'k4'")
    long = spark.createDataFrame([("x" * 400, 9)], "key string, n bigint")
    right = right.unionByName(long)
    for hot in (1, 2, 5000):
        got = join_frequent_first(left, right, "key", "n", hot).select("id", "key", "n")
        want = left.join(right, "key", "left").select("id", "key", "n")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 1, "block_rows": 2}], ids=["broadcast", "blocks"])
def test_tfidf_search(spark, docs, options):
    asked = {10: "cat on mat", 11: "unknown animals", 12: "nothing known"}
    q = spark.createDataFrame(list(asked.items()), "query_id bigint, text string")
    counts, idf = weights()
    unseen = math.log(len(TEXTS) + 1)
    want = []
    for qid, text in asked.items():
        qv = {w: n * idf.get(w, unseen) for w, n in Counter(words(text)).items()}
        ql = math.sqrt(sum(x * x for x in qv.values()))
        scored = []
        for i, c in counts.items():
            dv = {w: n * idf[w] for w, n in c.items()}
            s = sum(x * dv.get(w, 0) for w, x in qv.items())
            if s > 0:
                scored.append((-round(s / ql / math.sqrt(sum(x * x for x in dv.values())), 10), i))
        want += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:3])]
    got = sorted(tuple(r) for r in tfidf_search(docs, q, 3, **options).collect())
    assert got == sorted(want)


def test_hashed_tfidf(docs):
    model, vectors = fit_hashed_tfidf(docs.select("doc_id", "text"), 10_000)
    rows = {r.doc_id: r.vector for r in vectors.collect()}
    assert rows[1] == rows[4] and rows[1].size == 10_000
    counts, _ = weights()
    assert rows[1].numNonzeros() <= len(counts[1])


def embedding(text, dim=16):
    from hashlib import md5

    _, idf = weights()
    v = np.zeros(dim)
    for w, n in Counter(words(text)).items():
        h = md5(w.encode()).hexdigest()
        sign = 1 if int(h[8], 16) % 2 == 0 else -1
        v[int(h[:8], 16) % dim] += sign * n * idf.get(w, math.log(len(TEXTS) + 1))
    length = np.linalg.norm(v)
    return v / length if length else v


def test_embeddings(spark, docs):
    got = {r.doc_id: r.vec for r in embed_documents(docs, 16).collect()}
    assert got.keys() == TEXTS.keys()
    for i, (_, text) in TEXTS.items():
        assert got[i] == pytest.approx(embedding(text).tolist(), abs=1e-6)
    assert got[5] == [0.0] * 16
    other = spark.createDataFrame([(1, "a new cat")], "doc_id bigint, text string")
    vec = embed_texts(other, fit_terms(docs), 16).first().vec
    assert vec == pytest.approx(embedding("a new cat").tolist(), abs=1e-6)


def test_model_hook_loads_once_per_task(spark, docs, tmp_path):
    log = str(tmp_path / "loads")

    def make_model():
        with open(log, "a") as f:
            f.write("x")
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    rows = embed_with(docs.repartition(3), make_model).collect()
    assert {r.doc_id: r.vec for r in rows} == {i: [float(len(t)), 1.0] for i, (_, t) in TEXTS.items()}
    assert 1 <= len(open(log).read()) <= 3


def test_summary(docs):
    got = {r.doc_id: r.summary for r in summarize(docs, 1).collect()}
    assert got[5] == "" and got[1] == got[4]
    assert got[2] == "Animals sleep."
    full = {r.doc_id: r.summary for r in summarize(docs, 9).collect()}
    assert full[1] == TEXTS[1][1]


def test_graph_ranks_and_picks_equal_numpy(spark):
    """Rank by the whole similarity matrix, then picks by worth."""
    rng = np.random.default_rng(4)
    sentences = [" ".join(f"w{'abcdefgh'[i]}" for i in rng.integers(0, 8, 6)) for _ in range(9)]
    sentences[5] = sentences[2]
    rows = [(1, ". ".join(sentences) + "."), (2, "wa wb."), (3, "wc other."), (4, None), (5, "...")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    entries = sentence_entries(docs)
    found = entries.where("doc_id = 1").toPandas()
    x = found.pivot(index="sent", columns="term", values="x").fillna(0.0).to_numpy()
    assert x.shape[0] == 9 and np.allclose((x * x).sum(axis=1), 1.0)
    similar = x @ x.T
    rank = np.ones(9)
    for _ in range(4):
        rank = 0.15 + 0.85 * (similar @ (rank / similar.sum(axis=1)))
    ranked = sentence_ranks(entries, 4).where("doc_id = 1").groupBy("sent").agg({"rank": "max"}).orderBy("sent").collect()
    assert np.allclose([r[1] for r in ranked], rank)
    near, picks = np.zeros(9), []
    for _ in range(3):
        worth = np.round(rank * (1 - 0.5 * near), 10)
        worth[picks] = -1
        picks.append(int(worth.argmax()))
        near = np.maximum(near, similar[picks[-1]])
    got = {r.doc_id: r.summary for r in graph_summaries(docs, 3, 4).collect()}
    assert got[1] == " ".join(sentences[i] + "." for i in sorted(picks))
    assert {got[4], got[5]} == {""} and got[2] == "wa wb." and got[3] == "wc other."
    assert graph_summaries(docs.limit(0)).count() == 0


def test_control_pairs_differ_in_language(spark, docs):
    lang = {i: l for i, (l, _) in TEXTS.items()}
    for slots in (1, 4, 64):
        pairs = {r.doc_id: r.other_id for r in control_pairs(docs, slots).collect()}
        assert pairs.keys() == TEXTS.keys()
        assert all(lang[i] != lang[o] for i, o in pairs.items())
    only = control_pairs(docs.where("lang = 'en'")).collect()
    assert len(only) == 3 and all(r.other_id is None for r in only)


def test_report_and_pair_cosine(spark, docs):
    rows = {r.doc_id: r for r in summary_report(docs, 16).collect()}
    assert rows.keys() == TEXTS.keys()
    known = [r for i, r in rows.items() if i != 5]
    mean = lambda name: sum(getattr(r, name) for r in known) / len(known)
    assert mean("cos_summary") > mean("cos_other")
    vecs = embed_documents(docs, 16).withColumnRenamed("doc_id", "id")
    pairs = spark.createDataFrame([(1, 4), (1, 5)], "left_id bigint, right_id bigint")
    got = {(r.left_id, r.right_id): r.cosine for r in pair_cosine(pairs, vecs).collect()}
    assert got[1, 4] == pytest.approx(1.0) and got[1, 5] == 0.0


def test_keywords_follow_the_formulas(spark):
    """Features computed in plain Python for a text without stop words or endings."""
    text = "Delta moon Bravo. Bravo delta zinc, moon zinc! Bravo moon"
    df = spark.createDataFrame([(1, "xx", text)], "doc_id bigint, lang string, text string")
    sents = [[["Delta", "moon", "Bravo"]], [["Bravo", "delta", "zinc"], ["moon", "zinc"]], [["Bravo", "moon"]]]
    where, left, right, upper = defaultdict(list), defaultdict(list), defaultdict(list), Counter()
    for si, chunks in enumerate(sents):
        for ci, chunk in enumerate(chunks):
            for pi, w in enumerate(chunk):
                low = w.lower()
                where[low].append(si)
                if pi:
                    left[low].append(chunk[pi - 1].lower())
                if pi + 1 < len(chunk):
                    right[low].append(chunk[pi + 1].lower())
                if w[0].isupper() and (ci, pi) != (0, 0):
                    upper[low] += 1
    tf = {w: len(x) for w, x in where.items()}
    mean, std, most = np.mean(list(tf.values())), np.std(list(tf.values())), max(tf.values())
    s = {}
    for w in tf:
        case = upper[w] / (1 + math.log(tf[w]))
        pos = math.log(math.log(3 + np.median(where[w])))
        share = sum(len(set(x)) / len(x) for x in (left[w], right[w]) if x)
        rel = 1 + share * tf[w] / most
        s[w] = rel * pos / (case + tf[w] / (mean + std) / rel + len(set(where[w])) / 3 / rel)
    runs = Counter()
    for chunks in sents:
        for chunk in chunks:
            for n in range(2, 6):
                for i in range(len(chunk) - n + 1):
                    runs[tuple(w.lower() for w in chunk[i : i + n])] += 1
    want = {
        " ".join(g): math.prod(s[w] for w in g) / (c * (1 + sum(s[w] for w in g))) for g, c in runs.items()
    }
    got = extract_keywords(df, threshold=1e9, n_keywords=100).collect()
    assert {r.keyword: pytest.approx(r.score) for r in got} == want
    assert [r.keyword for r in sorted(got, key=lambda r: r["rank"])] == sorted(want, key=lambda k: (round(math.log(want[k]), 9), k))
    few = extract_keywords(df, threshold=0.6, n_keywords=2).collect()
    assert len(few) == 2 and all(r.score <= 0.6 for r in few)


def test_corpus_keywords_take_the_least_score(spark):
    rows = [(1, "a b", 0.5), (1, "c d", 0.1), (2, "a b", 1.0e-4)]
    df = spark.createDataFrame(rows, "doc_id bigint, keyword string, score double")
    assert [tuple(r) for r in corpus_keywords(df).collect()] == [("a b", 1.0e-4), ("c d", 0.1)]


def test_annotations_round_trip(docs):
    found = extract_keywords(docs)
    flat = as_annotations(found).select("doc_id", F.posexplode("keywords").alias("i", "k"))
    assert flat.count() == found.count()


def test_graph_summaries_write_nothing_and_take_any_batches(spark):
    from sahaf.session import STAGED

    text = "The {0} cat sat on a mat. A {0} dog ran over the mat. Rain fell on {0} hills. The dog and the {0} cat slept."
    docs = spark.createDataFrame([(i, text.format(w)) for i, w in enumerate(["red", "blue", "old", "new", "wet"])] + [(5, None), (0, "One more red line.")], "doc_id long, text string")
    before = len(STAGED)
    whole = sorted((r.doc_id, r.summary) for r in graph_summaries(docs).collect())
    ranks = {(r.doc_id, r.sent): r["rank"] for r in sentence_ranks(sentence_entries(docs)).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted((r.doc_id, r.summary) for r in graph_summaries(docs).collect()) == whole
        assert all(abs(ranks[r.doc_id, r.sent] - r["rank"]) < 1e-12 for r in sentence_ranks(sentence_entries(docs)).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(STAGED) == before and len(whole) == 7 and all(s for i, s in whole if i < 5)


def test_texts_move_in_parts_of_bounded_size(spark, monkeypatch):
    import sahaf.operators.terms as terms_module

    rows = [(i % 40, f"Word{'x' * (i % 7)} and word {i % 9}, and so on. " * 5) for i in range(80)] + [(None, "none"), (3, None), (4, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, r.term): r.tf for r in terms_module.term_counts(docs).collect()}
    grams = sorted(map(tuple, terms_module.ngram_counts(docs).collect()), key=str)
    monkeypatch.setattr(terms_module, "PART_BYTES", 500)
    assert terms_module.by_document(docs).rdd.getNumPartitions() > 20
    moved = terms_module.term_counts(docs, move_texts=True)
    assert {(r.doc_id, r.term): r.tf for r in moved.collect()} == want
    assert sorted(map(tuple, terms_module.ngram_counts(docs).collect()), key=str) == grams
    plan = moved._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_summaries_move_texts_and_sums_not_the_places_of_terms(spark, monkeypatch):
    """Whatever number of terms is sent, the summaries are the same; nothing is dealt anew by document after the weights."""
    from sahaf.operators import summarize as S

    rows = [(i % 7 if i else None, f"kedi uyur kedi w{i}x{chr(97 + i)}. köpek koşar hızlı! kuş {chr(98 + i % 5)}uçar kedi.\nson satır") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    out = S.summarize(docs, 2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan, plan
    want = sorted((r.doc_id is None, r.doc_id or 0, r.summary) for r in out.collect())
    assert len(want) == 20
    monkeypatch.setattr(S, "SENT_TERMS", 2)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.summary) for r in S.summarize(docs, 2).collect()) == want


def test_keyword_tokens_follow_the_text_in_partitions(docs, monkeypatch):
    """A task's tokens don't grow with the corpus; the keywords are the same."""
    from sahaf.operators import keywords, terms

    few = sorted(map(tuple, extract_keywords(docs, threshold=1e9).collect()))
    monkeypatch.setattr(terms, "PART_BYTES", 8)
    size = sum(len(t) for _, t in TEXTS.values())
    assert keywords.keyword_tokens(docs).rdd.getNumPartitions() == -(-size // 8)
    assert sorted(map(tuple, extract_keywords(docs, threshold=1e9).collect())) == few


def test_graph_summaries_move_to_their_terms_only_places_of_rare_ones(spark):
    docs = spark.createDataFrame([(1, "A red cat. A dog."), (2, "A blue cat.")], "doc_id long, text string")
    plan = sentence_entries(docs)._jdf.queryExecution().executedPlan().toString()
    assert "limit=65536," in plan and "limit=1024," not in plan
