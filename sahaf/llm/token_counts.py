"""Token counts of texts by a whole-token shortcut.

Before any text is read, every string of the vocabulary is encoded alone: those that give
their own id and nothing else are proven to be one token wherever they stand as a whole
pre-token, since the vocabulary merges nothing across pre-tokens. Their hashes go to the
tasks (8 bytes a vocabulary entry). A text is cut into pre-tokens in numpy; those that are
proven count one, and only the others are merged by the tokenizer, each distinct one once
while a worker remembers it. There is no shuffle, so no key can be hot.

Pre-tokens of ASCII fragments between blanks are runs of letters, single digits, runs of
other marks, and the contractions. A fragment with other characters, controls or a special
token's string is left to the tokenizer as it stands: white space is dropped, and nothing
composes or merges across an ASCII blank, so counts of fragments add up to those of the
text. Strings of special tokens count as the tokenizer's default has it.

Nulls: a null text is empty and has 0 tokens; a null id is kept. Long texts are counted
whole, one at a time beyond 4 MB. Ties don't arise. Repeated rows get a row each; an empty
table gives no rows. Columns of the names that are added are replaced, all others kept.
Pre-tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from sahaf.llm.words import _LOWER, _SPACE, blocks, raw, span_hashes

LIMIT = 2048
#: Pre-tokens that a worker remembers; beyond, it starts anew. Slots of the tables of proven strings, as bits.
MEMORY, SLOT_BITS = 2_000_000, 20
#: The split that the cuts here reproduce, and its contractions: fixed values of the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT, LONG = b"stmd", (b"re", b"ve", b"ll")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
#: Bytes that the cuts here don't know: controls and parts of longer characters.
_HARD = np.ones(256, dtype=bool)
_HARD[33:127] = False
_HARD[_SPACE] = False


def load(path: str):
    """The tokenizer of a file, and the strings of its special tokens.

    ValueError where the file does not split and normalise as the cuts here assume.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    splits, normal = parts["pre_tokenizer"] or {}, parts["normalizer"] or {}
    found = [p["pattern"].get("Regex") for p in splits.get("pretokenizers", []) if p["type"] == "Split"]
    kinds = [n["type"] for n in normal.get("normalizers", [])]
    if found != [SPLIT] or kinds != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path} does not split words as this counter does")
    return Tokenizer.from_file(path), [t["content"].encode() for t in parts["added_tokens"]]


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in vocabulary strings: itself where it can be printed, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str) -> list[str]:
    """The vocabulary's strings that, encoded alone, are one token, namely their own."""
    tokenizer, _ = load(path)
    suffix, names = "</w>", byte_names()
    asked = {}
    for name, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if name.endswith(suffix):
            try:
                asked[bytes(names[c] for c in name.removesuffix(suffix)).decode()] = number
            except (KeyError, UnicodeDecodeError):  # not the bytes of whole characters
                continue
    strings = [s for s in asked if s and not any(_SPACE[b] for b in s.encode())]
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return [s for s, e in zip(strings, encoded, strict=True) if e.ids == [asked[s]]]


def hashes(strings: list[str]) -> np.ndarray:
    ends = np.cumsum([len(s.encode()) for s in strings], dtype=np.int64)
    data = np.frombuffer("".join(strings).encode(), dtype=np.uint8)
    return span_hashes(data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if strings else np.zeros(0, np.uint64)


def cuts(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of each pre-token, or whole fragment left to the tokenizer, of texts laid end to end."""
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    edge |= solid[:-1] != solid[1:]
    solid = solid[1:-1]
    begin = np.flatnonzero(edge[:-1] & solid)
    end = np.flatnonzero(edge[1:] & solid) + 1

    # Fragments that the tokenizer must see whole.
    unknown = np.concatenate(([0], np.cumsum(_HARD[data])))
    hard = unknown[end] > unknown[begin]
    body = data.tobytes()
    for s in special:
        at = body.find(s)
        while at >= 0:
            hard[np.searchsorted(begin, at, side="right") - 1] = True
            at = body.find(s, at + 1)
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, begin[hard], 1)
    np.add.at(change, end[hard], -1)
    soft = np.cumsum(change[:-1]) == 0

    letter, digit = _LETTER[data], _DIGIT[data]
    kind = letter.astype(np.int8) + 2 * digit
    inner = np.zeros(n + 1, dtype=bool)
    inner[1:-1] = ((kind[1:] != kind[:-1]) | digit[1:]) & soft[1:]
    bound = edge | inner
    low = _LOWER[data]
    # An apostrophe that is a run of its own, before letters of the same fragment.
    quote = np.flatnonzero((data == 39) & soft & bound[:-1] & bound[1:])
    quote = quote[quote + 1 < n]
    quote = quote[letter[quote + 1] & ~edge[quote + 1]]
    size = np.where(np.isin(low[quote + 1], np.frombuffer(SHORT, np.uint8)), 2, 0)
    two = quote + 2 < n
    two[two] = ~edge[quote[two] + 2]
    for pair in LONG:
        fits = two.copy()
        fits[two] = (low[quote[two] + 1] == pair[0]) & (low[quote[two] + 2] == pair[1])
        size[fits] = 3
    quote, size = quote[size > 0], size[size > 0]
    bound[quote + 1] = False
    bound[quote + size] = True

    starts = np.flatnonzero(bound[:-1] & solid)
    ends = np.flatnonzero(bound[1:] & solid) + 1
    return starts, ends, span_hashes(np.where(soft, low, data), starts, ends)


class Counter:
    """Token counts of texts; remembers those of merged pre-tokens across tasks."""

    def __init__(self, path: str, proven: np.ndarray):
        self.tokenizer, self.special = load(path)
        # Two tables by different bits; the few strings that fit neither are merged like the rest.
        self.tables = []
        for shift in (64 - SLOT_BITS, 64 - 2 * SLOT_BITS):
            table = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
            slot = ((proven >> np.uint64(shift)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
            table[slot] = proven
            self.tables.append((np.uint64(shift), table))
            proven = proven[table[slot] != proven]
        self.clear()

    def clear(self) -> None:
        self.keys, self.sizes = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def merged(self, keys: np.ndarray, strings) -> np.ndarray:
        """Tokens of each pre-token; ``strings`` gives those at some places, for the tokenizer."""
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > MEMORY:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        new = at >= len(self.keys)
        new[~new] = self.keys[at[~new]] != distinct[~new]
        if new.any():
            found = self.tokenizer.encode_batch(strings(first[new]), add_special_tokens=False)
            everything = np.concatenate((self.keys, distinct[new]))
            order = np.argsort(everything, kind="stable")
            self.sizes = np.concatenate((self.sizes, np.fromiter((len(e.ids) for e in found), np.int64, len(found))))[order]
            self.keys = everything[order]
            at = np.searchsorted(self.keys, distinct)
        return self.sizes[at][inverse]

    def count(self, texts: pa.Array) -> np.ndarray:
        data, offsets = raw(texts)
        if not len(data):
            return np.zeros(len(texts), dtype=np.int64)
        starts, ends, h = cuts(data, offsets, self.special)
        rest = np.arange(len(h))
        for shift, table in self.tables:
            key = h[rest]
            rest = rest[table[((key >> shift) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)] != key]
        each = np.ones(len(h), dtype=np.int64)
        if len(rest):
            body = data.tobytes()
            a, b = starts[rest], ends[rest]
            each[rest] = self.merged(h[rest], lambda at: [body[x:y].decode() for x, y in zip(a[at].tolist(), b[at].tolist(), strict=True)])
        total = np.concatenate(([0], np.cumsum(each)))
        return np.diff(total[np.searchsorted(starts, offsets)])


_COUNTERS: dict[str, Counter] = {}


def counter(path: str, proven: Broadcast) -> Counter:
    if path not in _COUNTERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _COUNTERS[path] = Counter(path, proven.value)
    return _COUNTERS[path]


def counted(docs: DataFrame, path: str, limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to documents (text, ..); ``keep`` names the columns to keep, else all."""
    proven = docs.sparkSession.sparkContext.broadcast(np.sort(hashes(whole_tokens(path))))
    added = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is remembered comes back to the tasks of a worker with the module, not with the function.
        from sahaf.llm.token_counts import counter

        own = counter(path, proven)
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                texts = batch.column(0).slice(a, b - a)
                n = own.count(texts)
                columns = [c.slice(a, b - a) for c in batch.columns[1:]]
                columns += [pa.array(np.diff(raw(texts)[1])), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*(f"_{i}" for i in range(len(kept))), *added]
    rows = docs.select(F.col("text").alias("_text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)])
    fields = [StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(kept)]
    fields += [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    out = rows.mapInArrow(run, StructType(fields))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], *added)
