"""The parts in which the quality operator counts and joins."""

import numpy as np
from pyspark.sql import functions as F

from sahaf import session
from sahaf.llm import quality


def test_hashes_equal_those_of_spark(spark):
    rng = np.random.default_rng(4)
    a, b = (rng.integers(-(1 << 63), 1 << 63, 50) for _ in range(2))
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")
    want = [r.h for r in rows.select(F.xxhash64("a", "b").alias("h")).collect()]
    assert quality.hashed(a.view(np.uint64), b.view(np.uint64)).view(np.int64).tolist() == want


def test_parts_of_the_model_are_written_one_at_a_time(spark):
    """No key is in two parts, every word is in its own, and a part and its counts are gone when the next is made."""
    rng = np.random.default_rng(6)
    texts = [(" ".join(f"w{x}" for x in rng.integers(0, 60, 80)), "en") for _ in range(20)]
    docs = spark.createDataFrame(texts, "text string, lang string")
    before = set(session.STAGED)
    models, _ = quality.summands(docs)

    def left(name):
        return sum(f"/{name}-" in x for x in session.STAGED if x not in before)

    keys, sizes = [], []
    for part, model in enumerate(models):
        assert left("quality-model") == 1 and left("quality-trigrams") == quality.SLICES - 1 - part
        assert left("quality-texts") == 0
        own = [r.key for r in model.select("key").collect()]
        keys += own
        sizes.append(len(own))
    assert left("quality-model") == 0 and len(keys) == len(set(keys)) and sorted(sizes)[1] > 0
    words = {w for t, _ in texts for w in t.split()}
    tokens = [["<1>", "<2>", *t.split()] for t, _ in texts]
    grams = {k: {tuple(t[i : i + k]) for t in tokens for i in range(3 - k, len(t) - k + 1)} for k in (2, 3)}
    pairs, threes = {g for g in grams[2] if g[1] in words}, {g for g in grams[3] if g[2] in words}
    contexts = len({g[:2] for g in threes}) + len({g[:1] for g in pairs})
    assert len(keys) == len(words) + len(pairs) + len(threes) + contexts
