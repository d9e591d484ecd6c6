"""Operator 8: benchmark decontamination by greedy string tiling.

Texts and benchmark items are word sequences, without case or ASCII punctuation. A rolling (Karp-Rabin) hash
of every ``MIN_TILE`` words in a document is looked up among those of the benchmark. With an item whose words these
seeds can cover, hashes of longer runs find the longest match. It is checked word by word and marked as a tile, and so
on among the words that are left, while ``MIN_TILE`` of them match. An item is in a
document if tiles cover at least ``COVERAGE`` of its words, in whatever order they come. An item of fewer than
``MIN_TILE`` words is one seed of its own length: it is in a document if it occurs there as a whole.

The benchmark is a stated query set held against all documents. It is taken in blocks of whole items, each
different one once, cut where their text sizes add up to ``BLOCK_BYTES``, so what tasks receive is bounded (but
for a single larger item). With more than one block the texts are sifted first, by a bitmap of the seeds of all blocks:
one scan of all documents writes those with any seed, which are then held against each block.
"""

from __future__ import annotations

import string
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_and_text, item_blocks, steps, written

MIN_TILE = 5
COVERAGE = 0.8
BLOCK_BYTES = 16 << 20
#: Bits of the hashes of seeds that the bitmap for several blocks tells apart: 32 MB, whatever their number.
SEED_BITS = 28
BASE = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_SPACED = bytes(string.punctuation, "ascii")
TABLE = bytes.maketrans(_SPACED, b" " * len(_SPACED))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(TABLE).split()


class Items:
    """A block of the benchmark: its items as word numbers, how often each is there, and the hashes of their seeds."""

    def __init__(
        self,
        rows: list[tuple[int, str | None]],
        min_tile: int = MIN_TILE,
        coverage: float = COVERAGE,
        times: list[int] | None = None,
    ):
        self.min_tile, self.coverage = min_tile, coverage
        self.times = [1] * len(rows) if times is None else times
        self.number: dict[bytes, int] = {}
        self.ids, self.items = [], []
        by_size = defaultdict(list)
        for item_id, text in rows:
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in words(text)], dtype=np.int64)
            if len(ids):
                size = min(min_tile, len(ids))
                hashes = rolling(ids, size)
                by_size[size].append((hashes, np.full(len(hashes), len(self.items)), np.arange(len(hashes))))
            self.ids.append(item_id)
            self.items.append(ids)
        #: By length: the hashes in order, and the item and place of each.
        self.seeds = {}
        for size, parts in by_size.items():
            seeds, items, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(seeds, kind="stable")
            self.seeds[size] = seeds[order], items[order], places[order]

    def tiles(self, text: str | None) -> list[tuple[int, float, int]]:
        """``(item_id, coverage, tiles)`` of the items that the text contains."""
        return [(self.ids[k], covered, tiles) for k, covered, tiles in self.found(text)]

    def found(self, text: str | None) -> list[tuple[int, float, int]]:
        """The same with the items' places in the block."""
        number = self.number
        ids = np.array([number.get(w, -1) for w in words(text)], dtype=np.int64)
        return [f for size in self.seeds for f in self._found(ids, size)]

    def _found(self, ids: np.ndarray, size: int) -> list[tuple[int, float, int]]:
        seeds, seed_item, seed_place = self.seeds[size]
        # Every seed of an item counts once, however often it occurs in the text.
        hashes = np.unique(rolling(ids, size))
        low = np.searchsorted(seeds, hashes, "left")
        many = np.searchsorted(seeds, hashes, "right") - low
        if not many.any():
            return []
        seed = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        item, q = seed_item[seed], seed_place[seed]
        order = np.lexsort((q, item))
        item, q = item[order], q[order]
        found, running = [], None
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(item)) + 1, [len(item)]])
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            own = self.items[item[lo]]
            reach = np.zeros(len(own) + 1, dtype=np.int64)
            reach[q[lo:hi]] += 1
            reach[q[lo:hi] + size] -= 1
            if (np.cumsum(reach)[:-1] > 0).sum() < self.coverage * len(own):
                continue
            running = Running(ids) if running is None else running
            covered, tiles = tile(running, Running(own), size)
            if covered >= self.coverage * len(own):
                found.append((int(item[lo]), covered / len(own), tiles))
        return found


class Seeds:
    """A bitmap of the seeds of any number of blocks: a text that holds none of them holds none of the items."""

    def __init__(self):
        self.bits = np.zeros(1 << (SEED_BITS - 3), dtype=np.uint8)
        self.sizes: set[int] = set()

    def add(self, block: Items) -> None:
        # Words have other numbers in each block, so their checksums stand for them here.
        codes = np.array([zlib.crc32(w) for w in block.number], dtype=np.int64)
        for ids in block.items:
            if len(ids):
                size = min(block.min_tile, len(ids))
                self.sizes.add(size)
                byte, bit = self.slots(codes[ids], size)
                np.bitwise_or.at(self.bits, byte, bit)

    @staticmethod
    def slots(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        top = (rolling(codes, size) >> np.uint64(64 - SEED_BITS)).astype(np.int64)
        return top >> 3, (1 << (top & 7)).astype(np.uint8)

    def may_hold(self, text: str | None) -> bool:
        codes = np.array([zlib.crc32(w) for w in words(text)], dtype=np.int64)
        slots = (self.slots(codes, size) for size in self.sizes)
        return any((self.bits[byte] & bit).any() for byte, bit in slots)


class Running:
    """Word numbers whose runs of any length are hashed (Karp-Rabin, modulo 2**64) in one step each."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.used = np.zeros(len(ids), dtype=bool)
        powers = np.full(len(ids) + 1, BASE)
        powers[0] = 1
        self.up = np.multiply.accumulate(powers)
        powers[1:] = INVERSE
        down = np.multiply.accumulate(powers)[1:]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(spread(ids) * down, dtype=np.uint64)])

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Of the runs of ``size`` words from each place."""
        return (self.sums[at + size] - self.sums[at]) * self.up[at]

    def free(self, at: np.ndarray, size: int, marked: np.ndarray) -> np.ndarray:
        """The places whose runs are within the text and not marked; ``marked`` counts the words before a place."""
        at = at[at + size <= len(self.ids)]
        return at[marked[at + size] == marked[at]]


def tile(text: Running, item: Running, size: int) -> tuple[int, int]:
    """Words of the item covered by greedy tiles of at least ``size`` words, and the number of tiles.

    The longest length that has a match between unmarked words is found by bisection, as every match has
    shorter ones in it. All tiles of that length are marked, the first place in the text and in the item first, and
    the search goes on below it. No pair of places is ever spelled out, so repetitions cost no more than others.
    """
    places = np.arange(len(item.ids))
    starts = np.arange(len(text.ids) - size + 1)
    starts = starts[np.isin(text.hashes(starts, size), item.hashes(places[: len(places) - size + 1], size))]
    tiles, longest = 0, min(len(item.ids), len(text.ids))
    while longest >= size and not item.used.all():
        marked = [np.concatenate([[0], np.cumsum(x.used)]) for x in (text, item)]

        def matches(length: int, marked=marked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            b = item.free(places, length, marked[1])
            wanted = item.hashes(b, length)
            a = text.free(starts, length, marked[0])
            return a[np.isin(text.hashes(a, length), wanted)], b, wanted

        low, high = size - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(matches(middle)[0]) else (low, middle - 1)
        if low < size:
            break
        tiles += mark(text, item, low, *matches(low))
        longest = low - 1
    return int(item.used.sum()), tiles


def mark(text: Running, item: Running, length: int, at: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> int:
    """Mark tiles of one length, the number of which is returned."""
    open_ = defaultdict(list)
    for b, value in zip(places.tolist()[::-1], hashes.tolist()[::-1], strict=True):
        open_[value].append(b)
    tiles, end = 0, -1
    for a, value in zip(at.tolist(), text.hashes(at, length).tolist(), strict=True):
        if not open_:
            break
        if a < end or value not in open_:
            continue
        own = open_[value]
        while own and item.used[own[-1] : own[-1] + length].any():
            own.pop()
        if not own:
            del open_[value]
        elif (text.ids[a : a + length] == item.ids[own[-1] : own[-1] + length]).all():
            item.used[own[-1] : own[-1] + length] = True
            text.used[a : a + length] = True
            tiles, end = tiles + 1, a + length
    return tiles


def spread(ids: np.ndarray) -> np.ndarray:
    return (ids + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` words, modulo 2**64."""
    count = max(0, len(ids) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    values = spread(ids)
    for k in range(size):
        out = out * BASE + values[k : k + count]
    return out


def benchmark_blocks(
    benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, min_tile: int = MIN_TILE, coverage: float = COVERAGE
) -> Iterator[Items]:
    """The different items of the benchmark in blocks of at most ``block_bytes`` of text, one at a time on the driver."""
    for block in item_blocks(benchmark, block_bytes):
        yield Items([r[:2] for r in block], min_tile, coverage, [r[2] for r in block])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, coverage, tiles`` for each row of ``docs`` and item found in it.

    Null texts, and null items or items without words, match nothing. Repeated rows are found each, repeated
    items each. Without documents or items there are no rows. Of ``benchmark`` (item_id
    bigint, text) and ``docs`` no other columns are read.
    """
    rows, context = id_and_text(docs), docs.sparkSession.sparkContext
    blocks, seeds = [], Seeds()
    for items in benchmark_blocks(benchmark, block_bytes, min_tile, coverage):
        seeds.add(items)
        blocks.append(context.broadcast(items))
    if len(blocks) > 1:
        sieve = context.broadcast(seeds)

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches):
                yield batch.filter(pa.array([sieve.value.may_hold(t) for t in batch.column(1).to_pylist()], pa.bool_()))

        rows = written(rows.mapInArrow(sift, rows.schema), "seeded")
    out = None
    for shared in blocks:

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches):
                columns = defaultdict(list)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for at, covered, tiles in shared.value.found(text):
                        values = (doc_id, shared.value.ids[at], covered, tiles, shared.value.times[at])
                        for k, value in enumerate(values):
                            columns[k].append(value)
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64())
                arrays = [pa.array(columns[k], t) for k, t in enumerate(types)]
                yield pa.record_batch(arrays, ["doc_id", "item_id", "coverage", "tiles", "times"])

        found = rows.mapInArrow(search, "doc_id bigint, item_id bigint, coverage double, tiles int, times bigint")
        found = found.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("time", "times")
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item of the benchmark."""
    at = docs.columns.index("text")
    for items in benchmark_blocks(benchmark, block_bytes, min_tile, coverage):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, at):
                yield batch.filter(pa.array([not shared.value.tiles(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
