"""Operators 11 to 13 against brute force, the tokenizer, and on nulls, empty, long, tied and repeated rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sahaf.llm import prefix_trie, resampling, token_counts
from sahaf.llm.queries import vocabulary
from sahaf.llm.registry import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# 11: conversation trie


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, cs in members.items():
        gain = (len(cs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += gain
    out = []
    for node, cs in members.items():
        ended = ",".join(str(c) for c in sorted(cs) if full[c] == node)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ended.encode()).hexdigest()
        out.append((min(cs), len(node), parent, len(cs), children[node], leaves[node], saved[node], sha))
    return sorted(map(repr, out))


def conversations(rng, n, longest, words):
    rows = []
    for c in range(n):
        for turn in range(int(rng.integers(1, longest + 1))):
            text = " ".join(f"w{x}" for x in rng.integers(0, words, 3)) if turn else "hello there"
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    return rows


def check_trie(spark, rows, schema="conv_id long, turn long, role string, text string"):
    got = prefix_trie.trie(spark.createDataFrame(rows, schema).repartition(5))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_trie([r[:4] for r in rows])


def test_trie_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = conversations(rng, 150, 6, 2)
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(300) for t in range(3)]  # copies
    rows += [(70_000 * i, 0, "user", "same 0") for i in range(1, 5)]  # several ranges of ids
    rows += [(2000, None, "user", "first"), (2000, 0, None, None), (2001, 0, None, ""), (2001, 1, "user", "x" * 100_000)]
    rows += [(2040, 0, "user", "again"), (2040, 0, "user", "again"), (-7, 0, "user", "below"), (-20, 0, "user", "zero"), (-20, 1, "user", "one")]
    rows += [(None, 0, "user", "of no conversation")]
    check_trie(spark, rows)


def test_trie_of_long_chains(spark):
    rng = np.random.default_rng(2)
    rows = [(0, t, "user", f"t{t}") for t in range(90)] + [(20, t, "user", f"t{t}") for t in range(60)]
    rows += [(40, t, "user", f"t{t}" if t < 25 else f"u{t}") for t in range(88)] + [(60, 0, "user", "t0")]
    rows += conversations(rng, 0, 1, 1)
    check_trie(spark, rows)


def test_trie_takes_few_steps_through_a_long_conversation(spark, monkeypatch):
    taken = []
    kept = prefix_trie.staged
    monkeypatch.setattr(prefix_trie, "staged", lambda df, name: taken.append(name) or kept(df, name))
    check_trie(spark, [(0, t, "user", f"t{t}") for t in range(300)] + [(20, 0, "user", "t0")])
    assert taken.count("trie-level") <= 5


def test_trie_of_few_rows_and_other_columns(spark):
    schema = "conv_id long, turn long, role string, text string, depth string, path string, block string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    check_trie(spark, [(5, 0, "user", "a b", "x", "y", "z"), (6, 0, "user", "a b", "x", "y", "z")], schema)
    # 21 and 30 of block 20 have no first turns to take, so some are left without a turn.
    check_trie(spark, [(c, 0, "user", "a") for c in range(21, 40)])


# 12: token counts

PIECES = [
    "it's", "IT'S", "'sam", "''s", "x'", "don't!'re", "\"'s", "'ll", "'l", "'Re", "éa's", "É'S", "Å", "KK", "a b", "12a3",
    "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "<|endoftext|>'s", "\x1c\x1d", "a\x00b", "\x7f", "ﬁ", "日本語", "é", "́",
    "!!!", "--'s", " ", "\n", "\t", "  ", "the", "hello", "...", "'", "s", "re", " ", "²", "x²", "İ", "ß", "\x85",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_proven_strings_are_one_token(tokenizer):
    strings = token_counts.whole_tokens(vocabulary())
    assert len(strings) > 30_000 and len(set(strings)) == len(strings)
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(strings, add_special_tokens=False))
    assert len(set(token_counts.hashes(strings).tolist())) == len(strings)


def test_counts_equal_the_tokenizer(tokenizer):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(PIECES, int(rng.integers(0, 14)))) for _ in range(4000)] + [None, "", " ", "the" * 1000]
    own = token_counts.Counter(vocabulary(), np.sort(token_counts.hashes(token_counts.whole_tokens(vocabulary()))))
    want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert own.count(pa.array(texts)).tolist() == want
    assert own.count(pa.array(texts).slice(7)).tolist() == want[7:]


def test_only_the_rest_is_merged():
    strings = token_counts.whole_tokens(vocabulary())
    own = token_counts.Counter(vocabulary(), np.sort(token_counts.hashes(strings)))
    asked = []
    merged = own.merged
    own.merged = lambda keys, at: asked.append(at(np.arange(len(keys)))) or merged(keys, at)
    assert own.count(pa.array(["the house the qzxqzx house THE"])).tolist() == [5 + len(own.tokenizer.encode("qzxqzx").ids)]
    assert asked == [["qzxqzx"]]


def test_count_query_shape(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 3)
    rows = [(i, "".join(PIECES[i : i + 9]), "kept", i, True) for i in range(30)] + [(None, None, "n", 0, None), (1, "word " * 3000, "n", 0, None)]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_0` string, n_tokens long, over_limit boolean").repartition(3)
    out = token_counts.counted(docs, vocabulary(), 20)
    assert out.columns == ["doc_id", "text", "_0", "n_bytes", "n_tokens", "over_limit"]
    want = Counter()
    for doc_id, text, other, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want[(doc_id, text, other, len((text or "").encode()), n, n > 20)] += 1
    assert Counter(map(tuple, out.collect())) == want
    assert token_counts.counted(docs.limit(0), vocabulary()).count() == 0


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_counts.whole_tokens(public_tokenizers.path("byte_bpe_50k.json"))


# 13: importance resampling


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute_resample(docs, target, percent=25):
    counts = [Counter(bucket(f) for t in texts for f in plain_features(t)[1]) for texts in ([t for _, t in docs], target)]
    s_all, t_all = (sum(c.values()) for c in counts)
    gain = {b: math.floor(1000 * math.log((counts[1][b] + 1) * (s_all + 10_000) / ((n + 1) * (t_all + 10_000)))) for b, n in counts[0].items()}
    rows = []
    for i, text in docs:
        n, found = plain_features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = Counter()
    rank = defaultdict(list)
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        rank[r].append(place)
    for r in rows:
        drawn[(r[0], *r[2:], rank[r].pop() if rank[r] else None)] += 1
    return drawn


def prose(rng, n, words):
    return " ".join(f"w{x}" for x in rng.integers(0, words, n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    docs = [(i, prose(rng, int(rng.integers(5, 60)), 50 if i % 3 else 2000)) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "\x7f _"), (1003, "é" * 70 + " x" * 30), (1004, prose(rng, 20_000, 500))]
    docs += [docs[4]] * 3 + [(None, docs[7][1] * 2)] * 150 + [(None, "lone " * 25)]
    return docs, [prose(rng, 40, 50) for _ in range(20)] + [None, "É é"]


@pytest.mark.parametrize("few", [1, 50, 4096])
def test_resampling_equals_brute_force(spark, texts, monkeypatch, few):
    docs, target = texts
    monkeypatch.setattr(resampling, "FEW", few)
    monkeypatch.setattr(resampling, "RANGE_ROWS", 40)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank long, row string").repartition(6)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.resample(frame, goal)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, out.collect())) == brute_resample(docs, target)


def test_resampling_of_few_rows(spark):
    schema = "doc_id long, text string"
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(spark.createDataFrame([], schema), goal).count() == 0
    rows = [(i, "word " * 30) for i in range(3)]
    assert resampling.resample(spark.createDataFrame(rows, schema), goal).where("rank IS NOT NULL").count() == 0
    every = resampling.resample(spark.createDataFrame(rows, schema), goal.limit(0), percent=100).collect()
    assert sorted(r["rank"] for r in every) == [1, 2, 3]


def test_weighted_median_leaves_a_quarter_on_each_side():
    rng = np.random.default_rng(6)
    for _ in range(50):
        groups = [sorted((int(x),) for x in rng.integers(0, 1 << 40, int(rng.integers(1, 60)))) for _ in range(int(rng.integers(1, 9)))]
        pivot = resampling.weighted_median([(len(g), g[len(g) // 2]) for g in groups])
        every = [x for g in groups for x in g]
        under = sum(x < pivot for x in every)
        assert len(every) < 4 or (under >= len(every) // 4 and len(every) - under >= len(every) // 4)


def test_cutoff_over_many_passes(spark, monkeypatch):
    monkeypatch.setattr(resampling, "FEW", 2)
    rng = np.random.default_rng(8)
    rows = [(int(a), 0, int(b), 1, i) for i, (a, b) in enumerate(rng.integers(0, 9, (3000, 2)))]
    keys = spark.createDataFrame(rows, ", ".join(f"{k} long" for k in resampling.KEY)).repartition(7)
    for wanted in (0, 1, 700, 2999):
        assert resampling.cutoff(keys, wanted) == sorted(rows)[wanted]
    assert resampling.cutoff(keys, 3000) is None
