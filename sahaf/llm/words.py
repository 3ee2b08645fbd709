"""Words and word shingles of whole Arrow text columns, in numpy.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return; A to Z count as a to z. No byte of a longer UTF-8 sequence is
one of these, so bytes give the same words as characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

K = 5
#: Bytes of text worked on at once; a longer single text is worked on alone.
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20250601)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > BLOCK_BYTES + 1:
        return powers(_BASE, n), powers(_INVERSE, n)
    if not _POWERS:
        _POWERS["up"], _POWERS["down"] = powers(_BASE, BLOCK_BYTES + 1), powers(_INVERSE, BLOCK_BYTES + 1)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), by differences of one running sum."""
    up, down = _tables(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[values] * up[: len(values)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _PLACE[63])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the len + 1 offsets of its texts; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most BLOCK_BYTES of text, or of one longer text."""
    _, offsets = raw(texts)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end
        row = end


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in turn, and the len + 1 offsets of the texts in them."""
    data, offsets = raw(texts)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(solid[:-1], out=before[1:])
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(solid[1:], out=after[:-1])
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


def shingles(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in turn, and the len + 1 offsets.

    A text of fewer than ``k`` words has its whole sequence as one shingle, one without
    words has none.
    """
    h, at = words(texts)
    n = np.diff(at)
    made = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    to = np.concatenate(([0], np.cumsum(made)))
    first = np.repeat(at[:-1] - to[:-1], made) + np.arange(to[-1])
    length = np.repeat(np.minimum(n, k), made)
    padded = np.concatenate((h, np.zeros(k, dtype=np.uint64)))
    out = length.astype(np.uint64) * _PLACE[62]
    for j in range(k):
        part = padded[first + j] * _PLACE[j]
        if j and (length <= j).any():
            part[length <= j] = 0
        out += part
    out = mixed(out)
    for a, b in zip(to[:-1].tolist(), to[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[to[:-1][made > 0]] = True
    total = np.concatenate(([0], np.cumsum(new)))
    return out[new], total[to]
