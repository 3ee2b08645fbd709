"""Packing documents into training sequences by a grouping genetic algorithm.

A text is tokenised whole and ends with id 0. Longer ones are cut into pieces of the
sequence length; full pieces are sequences of their own. The other pieces are dealt at
random over blocks. Islands, several to a block, each breed packings of the block:
crossover injects well-filled bins of one parent into the other, removes the bins that
then hold an item twice, and puts displaced items back best-fit. After each epoch an
island's best packing migrates to the next island. Bins that stay under-filled are
opened, and their pieces packed again with those of other blocks, until one block is left.

Nulls: a null text is empty and gives one piece, the id 0; a null id is kept. Equal rows
are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.llm.frames import parts
from sahaf.llm.words import _LOWER, _SPACE, blocks, raw, span_hashes
from sahaf.session import staged

LENGTH = 2048
#: Pieces of a block, islands on it, epochs with migration between, packings of an island, offspring per epoch.
BLOCK, ISLANDS, EPOCHS, POPULATION, OFFSPRING = 2_000, 3, 2, 4, 16
#: A bin under this part of the length is opened and packed again with those of other blocks.
WEAK = 0.97
#: Token lists that a Python worker remembers; beyond, it starts anew.
MEMORY = 3_000_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK[48:58] = _MARK[39] = False
_MARK &= ~_LETTER
#: Texts with these are tokenised as a whole: fixed values of the vocabulary.
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


class Encoder:
    """Token ids of texts, with the ids of distinct fragments remembered across tasks.

    The vocabulary drops white space and takes runs of letters, digits and marks one by
    one, so ids of a text are those of its fragments in turn: it is cut at blanks, and
    between an ASCII letter and an ASCII mark other than the apostrophe. A to Z are
    lowered first, except in front of a non-ASCII byte, which may combine with them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=self.kind)

    def learn(self, keys: np.ndarray, fragments: list[str]) -> None:
        begin, count, ids = [], [], []
        base = len(self.flat)
        for i in range(0, len(fragments), 20_000):
            own = fragments[i : i + 20_000]
            starts = np.cumsum([0, *(len(w) + 1 for w in own[:-1])])
            found = self.tokenizer.encode(" ".join(own), add_special_tokens=False)
            at = np.fromiter((a for a, _ in found.offsets), dtype=np.int64, count=len(found.ids))
            cut = np.searchsorted(at, starts)
            begin.append(base + cut)
            count.append(np.diff(np.append(cut, len(found.ids))))
            ids.append(np.array(found.ids, dtype=self.kind))
            base += len(found.ids)
        merged = np.concatenate((self.keys, keys))
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.begin = np.concatenate((self.begin, *begin))[order]
        self.count = np.concatenate((self.count, *count))[order]
        self.flat = np.concatenate((self.flat, *ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, each followed by 0, and the len + 1 offsets."""
        data, offsets = raw(texts)
        n = len(texts)
        body = data.tobytes()
        if any(s in body for s in SPECIAL):
            whole = [self.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts.to_pylist()]
            sizes = np.fromiter(map(len, whole), dtype=np.int64, count=n)
            ids = np.fromiter(chain.from_iterable(whole), dtype=np.uint32, count=int(sizes.sum()))
            return ids, np.concatenate(([0], np.cumsum(sizes)))
        if not len(data):
            return np.zeros(n, dtype=np.uint32), np.arange(n + 1)
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        edge[[0, -1]] = True
        letter, mark = _LETTER[data], _MARK[data]
        edge[1:-1] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:]) | ~solid[:-1] | ~solid[1:]
        starts = np.flatnonzero(solid & edge[:-1])
        ends = np.flatnonzero(solid & edge[1:]) + 1
        low = _LOWER[data]
        keep = np.flatnonzero(data[1:] >= 128)
        low[keep] = data[keep]
        h = span_hashes(low, starts, ends)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > MEMORY:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if not known.all():
            where = first[~known]
            text = low.tobytes()
            spans = zip(starts[where].tolist(), ends[where].tolist(), strict=True)
            self.learn(distinct[~known], [text[a:b].decode() for a, b in spans])
            at = np.searchsorted(self.keys, distinct)
        count = self.count[at][inverse]
        begin = self.begin[at][inverse]
        to = np.concatenate(([0], np.cumsum(count)))
        ids = self.flat[np.repeat(begin - to[:-1], count) + np.arange(to[-1])]
        ends_of = to[np.searchsorted(starts, offsets)] + np.arange(n + 1)
        out = np.zeros(len(ids) + n, dtype=np.uint32)
        body_of = np.ones(len(out), dtype=bool)
        body_of[ends_of[1:] - 1] = False
        out[body_of] = ids
        return out, ends_of


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of rows (doc_id, text); ``row`` tells pieces apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Small ids come back to the tasks of a worker with the module, not with the function.
        from sahaf.llm.packing import encoder

        own = encoder(path)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts, ids_of = batch.column(1), batch.column(0)
            for a, b in blocks(texts):
                ids, at = own.encode(texts.slice(a, b - a))
                view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                sizes = np.diff(at)
                n = -(-sizes // length)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * length
                size = np.minimum(sizes[doc] - start, length)
                begin = (at[:-1][doc] + start) * 4
                spans = zip(begin.tolist(), (begin + size * 4).tolist(), strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": row + np.arange(len(doc)),
                        "doc_id": ids_of.slice(a, b - a).take(pa.array(doc)),
                        "piece": piece.astype(np.int32),
                        "start": start,
                        "length": size,
                        "ids_crc32": np.fromiter((zlib.crc32(view[x:y]) for x, y in spans), np.int64, len(doc)),
                    }
                )
                row += len(doc)

    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Bins:
    """A packing: the items of each bin, and bins by free room for best fit."""

    def __init__(self, sizes: list[int], room: int):
        self.sizes, self.room = sizes, room
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: dict[int, list[int]] = {}
        self.mask = 0

    def add_bin(self, items: list[int], free: int) -> None:
        self._file(len(self.items), free)
        self.items.append(items)
        self.free.append(free)

    def _file(self, b: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(b)
        self.mask |= 1 << free

    def put(self, item: int) -> None:
        """Into the bin that has the least room of those that have enough, or a new one."""
        size = self.sizes[item]
        fit = self.mask >> size
        if not fit:
            self.add_bin([item], self.room - size)
            return
        free = size + (fit & -fit).bit_length() - 1
        held = self.by_free[free]
        b = held.pop()
        if not held:
            self.mask ^= 1 << free
        self.items[b].append(item)
        self.free[b] = free - size
        self._file(b, free - size)

    def fitness(self) -> float:
        """Mean square fill: rewards full bins, so that few bins hold what is left."""
        return sum((self.room - f) ** 2 for f in self.free) / (len(self.free) * self.room**2)

    def genome(self) -> list[int]:
        out = [0] * len(self.sizes)
        for b, items in enumerate(self.items):
            for i in items:
                out[i] = b
        return out


def from_genome(genome: list[int], sizes: list[int], room: int) -> Bins:
    held: dict[int, list[int]] = {}
    for i, b in enumerate(genome):
        held.setdefault(b, []).append(i)
    out = Bins(sizes, room)
    for items in held.values():
        out.add_bin(items, room - sum(sizes[i] for i in items))
    return out


def best_fit(order: list[int], sizes: list[int], room: int) -> Bins:
    out = Bins(sizes, room)
    for i in order:
        out.put(i)
    return out


def cross(a: Bins, b: Bins, share: float, rng: np.random.Generator) -> Bins:
    """A child of ``a`` with whole well-filled bins of ``b``."""
    order = sorted(range(len(b.items)), key=lambda x: b.free[x])
    well = order[: max(1, int(len(order) * 0.7))]
    chosen = [x for x, r in zip(well, rng.random(len(well)).tolist(), strict=True) if r < share] or well[:1]
    taken = {i for x in chosen for i in b.items[x]}
    out, displaced = Bins(a.sizes, a.room), []
    for x in chosen:
        out.add_bin(list(b.items[x]), b.free[x])
    for items, free in zip(a.items, a.free, strict=True):
        if taken.isdisjoint(items):
            out.add_bin(list(items), free)
        else:
            displaced += [i for i in items if i not in taken]
    # The emptiest bins are opened too: their items may fit elsewhere.
    for i in sorted(displaced, key=lambda i: -a.sizes[i]):
        out.put(i)
    return out


def evolve(sizes: list[int], room: int, genomes: list[list[int]], seed: int, offspring: int = OFFSPRING) -> list[Bins]:
    """One epoch of an island: its packings by falling fitness. Without genomes it begins with best fit."""
    rng = np.random.default_rng(seed)
    falling = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    people = [from_genome(g, sizes, room) for g in genomes] or [best_fit(falling, sizes, room)]
    least = -(-sum(sizes) // room)
    while len(people) < POPULATION:
        noise = rng.random(len(sizes)) * 0.3 * room
        people.append(best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i] - noise[i]), sizes, room))
    scored = sorted(((p.fitness(), k, p) for k, p in enumerate(people)), key=lambda x: (-x[0], x[1]))[:POPULATION]
    for k in range(offspring):
        if len(scored[0][2].items) <= least:
            break
        i, j = sorted(rng.choice(len(scored), 2, replace=False).tolist())
        if k % 2:
            i, j = j, i
        child = cross(scored[i][2], scored[j][2], float(rng.uniform(0.05, 0.4)), rng)
        scored[-1] = max(scored[-1], (child.fitness(), -k, child), key=lambda x: x[0])
        scored.sort(key=lambda x: -x[0])
    return [p for _, _, p in scored]


def _epoch(room: int, number: int):
    def run(key: tuple, items: pd.DataFrame, people: pd.DataFrame) -> pd.DataFrame:
        block, island = key
        sizes = items.sort_values("row")["length"].tolist()
        genomes = [list(g) for g in people.sort_values(["fitness", "origin"], ascending=[False, True])["genome"]]
        best = evolve(sizes, room, genomes[:POPULATION], hash((int(block), int(island), number)) & 0xFFFFFFFF)[:2]
        return pd.DataFrame(
            {"block": block, "island": island, "origin": island, "fitness": [p.fitness() for p in best], "genome": [p.genome() for p in best]}
        )

    return run


def _placed(room: int):
    def run(items: pd.DataFrame, people: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("row", ignore_index=True)
        best = people.sort_values(["fitness", "island"], ascending=[False, True]).iloc[0]
        items = items.assign(bin=np.asarray(best["genome"], dtype=np.int64))
        fill = items.groupby("bin")["length"]
        return items.assign(offset=fill.cumsum() - items["length"], fill=fill.transform("sum"))[
            ["row", "length", "block", "bin", "offset", "fill"]
        ]

    return run


POPULATION_SCHEMA = "block long, island int, origin int, fitness double, genome array<int>"


def packed_blocks(items: DataFrame, room: int) -> DataFrame:
    """(row, length, block, bin, offset, fill) of items (row, length, block)."""
    spark = items.sparkSession
    islands = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    people = spark.createDataFrame([], POPULATION_SCHEMA)
    for number in range(EPOCHS):
        ours = islands.groupBy("block", "island").cogroup(people.groupBy("block", "island"))
        people = staged(ours.applyInPandas(_epoch(room, number), POPULATION_SCHEMA), "pack-islands")
        if number + 1 < EPOCHS:
            best = people.groupBy("block", "island").agg(F.max_by("genome", "fitness").alias("genome"), F.max("fitness").alias("fitness"))
            guests = best.select(
                "block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("island").alias("origin"), "fitness", "genome"
            )
            people = people.union(guests)
    schema = "row long, length long, block long, bin long, offset long, fill long"
    return items.groupBy("block").cogroup(people.groupBy("block")).applyInPandas(_placed(room), schema)


def packed(pieces: DataFrame, room: int = LENGTH) -> DataFrame:
    """(row, sequence_id, offset) of pieces (row, length), in as few sequences as the search finds."""
    full = pieces.where(F.col("length") == room).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < room).select("row", "length")
    done, number = [full], 0
    while True:
        count = left.count()
        if not count:
            break
        n = parts(count, BLOCK)
        block = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(n)).cast("long")
        placed = staged(packed_blocks(left.withColumn("block", block), room), "pack-placed")
        number += 1
        sequence = (F.lit(number) * F.lit(1 << 56) + F.col("block") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id")
        weak = F.col("fill") < int(room * WEAK)
        last = n == 1
        ready = placed if last else placed.where(~weak)
        done.append(ready.select("row", sequence, "offset"))
        if last:
            break
        left = placed.where(weak).select("row", "length")
        if left.count() >= count:
            done.append(placed.where(weak).select("row", sequence, "offset"))
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of rows (doc_id, text)."""
    pieces = staged(token_pieces(docs, path, length), "pack-pieces")
    places = packed(pieces.select("row", "length"), length)
    return pieces.join(places, "row").drop("row")
