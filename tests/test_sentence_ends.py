"""Learned sentence ends against plain Python and on planted abbreviations and ordinals."""

import math
import re
from collections import Counter

import pytest

from sahaf.operators import sentence_ends as S

WORDS = "nation water letter garden window mother number summer winter person answer market".split()


def planted():
    """Documents (doc_id, text, lang): abbreviations, ordinals before small and large words, plain ends."""
    rows = []
    for i in range(60):
        a, b, c = (WORDS[(i * k + k) % len(WORDS)] for k in (1, 5, 7))
        end = WORDS[i % len(WORDS)]
        en = f"The {a} met Prof. Miller near the {b}. The {c} of Dr. Brown saw a {end}! The {b} had 3.5 parts, e.g. Two {c}. The {a} ran."
        de = f"Der {a} kam am {i % 28 + 1}. Oktober zur {b}. Die {c} war z. B. am {end}. Der {a} sah 12. die {b}.\nDer Rest {a}"
        rows += [(2 * i, en, "en"), (2 * i + 1, de, "de")]
    return rows


ODD = [(500, None, "en"), (501, "", None), (502, "  \n \t", "de"), (None, "One. Two? Three", None), (None, "One. Two? Three", None), (7, "A...b ... c. 5.", "xx")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 0, "w") for r in planted() + ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, i int, word string")


def plain_chunks(text):
    return re.findall(r"[ \t\r\f\n]*[^ \t\r\f\n]+(?:[ \t\r\f]*\n)?", text or "")


def plain_kind(chunk):
    bare = re.sub(r"^[\W_]+|[\W_]+$", "", chunk).lower()
    return "#" if re.fullmatch("[0-9]+", bare) else bare


def has_dot(chunk):
    return re.search(r"[^\W_]\.[\"'”’»)\]]*\s*$", chunk) is not None


def low(chunk):
    return (m := re.search(r"[^\W_]", chunk)) is not None and m[0].islower()


def nexts(parts):
    return [None if p.endswith("\n") or j + 1 == len(parts) else parts[j + 1] for j, p in enumerate(parts)]


def plain_statistics(rows):
    n, dots, lows = Counter(), Counter(), Counter()
    for _, text, lang in rows:
        parts = plain_chunks(text)
        for chunk, after in zip(parts, nexts(parts), strict=True):
            key = (lang or "", plain_kind(chunk))
            n[key] += 1
            dots[key] += has_dot(chunk)
            lows[key] += has_dot(chunk) and after is not None and low(after)
    out = {}
    for key, k in dots.items():
        lang, word = key
        if not k or not word:
            continue
        total = sum(v for (x, w), v in n.items() if x == lang and w)
        share = sum(v for (x, w), v in dots.items() if x == lang and w) / total
        rest = n[key] - k
        null = k * math.log(share) + (rest * math.log(1 - share) if rest else 0)
        likely = 2 * (k * math.log(0.99) + rest * math.log(0.01) - null)
        size = len(word.replace(".", ""))
        out[key] = (n[key], k, lows[key], likely * math.exp(-size) * (word.count(".") + 1) * float(size) ** -rest)
    return out


def plain_sentences(text, lang, short, ordinals):
    parts, out, run = plain_chunks(text), [], ""
    for chunk, after in zip(parts, nexts(parts), strict=True):
        run += chunk
        end = after is None or re.search(r"[.!?][\"'”’»)\]]*\s*$", chunk) is not None
        if end and after is not None and has_dot(chunk):
            word = plain_kind(chunk)
            end = (lang, word) not in short and not (word == "#" and (low(after) or (lang, plain_kind(after)) in ordinals))
        if end:
            out.append(run)
            run = ""
    return out


def test_statistics_equal_plain_python(docs):
    want = plain_statistics(planted() + ODD)
    got = {(r.lang, r.word): (r.n, r.n_dot, r.n_lower, r.score) for r in S.dot_statistics(docs).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key][:3] == row[:3]
        assert got[key][3] == pytest.approx(row[3], rel=1e-9, abs=1e-12)


def test_abbreviations_and_ordinals_are_found(docs):
    short = {(r.lang, r.word) for r in S.abbreviations(S.dot_statistics(docs)).collect()}
    assert {("en", "prof"), ("en", "dr"), ("en", "e.g"), ("de", "z"), ("de", "b")} <= short
    assert not any(w in WORDS or w in ("miller", "brown") for _, w in short)
    ordinals = {(r.lang, r.word) for r in S.ordinal_words(S.after_numbers(docs)).collect()}
    assert ("de", "oktober") in ordinals
    assert not {("de", "der"), ("en", "the")} & ordinals


def test_sentences_equal_plain_python(docs):
    short, ordinals = S.abbreviations(S.dot_statistics(docs)), S.ordinal_words(S.after_numbers(docs))
    known = [{(r.lang, r.word) for r in x.collect()} for x in (short, ordinals)]
    got = Counter((r.doc_id, r.sent, r.sentence) for r in S.learned_sentences(docs).collect())
    want = Counter((i, j, s) for i, t, x in planted() + ODD for j, s in enumerate(plain_sentences(t, x or "", *known)))
    assert got == want
    whole = {i: "" for i, _, _ in planted()}
    for (i, _, s), _ in sorted(got.items(), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1])):
        if i in whole and i != 7:
            whole[i] += s
    assert all(whole[i] == t for i, t, _ in planted() if i != 7)
    sample = [s.strip() for i, _, s in sorted(k for k in got if k[0] == 1)]
    assert len(sample) == 4 and "Oktober" in sample[0] and "z. B. am" in sample[1] and "12. die" in sample[2]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert S.dot_statistics(none).count() == 0 and S.learned_sentences(none).count() == 0
    shout = spark.createDataFrame([(1, "No. Go. So.", "en")], "doc_id long, text string, lang string")
    assert all(r.score <= 0.3 for r in S.dot_statistics(shout).collect())


def test_small_tables_are_broadcast(spark, docs):
    """Neither the joins on words nor anything else moves texts before they meet their ends."""
    plan = S.learned_sentences(docs)._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") == 0 and plan.count("BatchEvalPython") == 0
    assert "BroadcastHashJoin" in plan
