"""Memory and results of word hashing in blocks."""

import numpy as np
import pyarrow as pa

from sahaf.llm import words


def test_kept_tables_are_small_and_long_texts_hash_alike():
    rng = np.random.default_rng(1)
    parts = [f"w{x}" for x in rng.integers(0, 1000, 200_000)]
    texts = pa.array([" ".join(parts), " ".join(parts[:50]), None, " ".join(parts[50:90])])
    assert len(texts[0].as_py()) > words.BLOCK_BYTES
    got = [words.words(texts.slice(a, b - a)) for a, b in words.blocks(texts)]
    assert len(got) > 1 and np.concatenate([np.diff(at) for _, at in got]).tolist() == [200_000, 50, 0, 40]
    h = np.concatenate([h for h, _ in got])
    assert (h[200_000:200_050] == h[:50]).all() and (h[200_050:] == h[50:90]).all()
    # Every Python worker keeps these, two or more to an executor.
    assert sum(x.nbytes for x in words._POWERS.values()) <= 16 << 20
