"""Operator 12: ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks. A document's signature is a Bloom filter of its terms, and of its terms
with the ``LEVELS`` of occurrences they reach. Documents of a block have signatures of one length, a power of two
by their number of terms, so that all are about equally full. A block stores them sliced: for each signature bit the
bitmap of the documents that have it set. Beside the slices are the documents' lengths and exact term counts.

The slices of a query term, put together by "and", are a bitmap that marks at least all documents with the term.
The sums of these bitmaps, weighted by the terms and the occurrences of their level, are upper bounds of all scores of
a block. A document whose bound is below the score of the ``k``-th best document seen so far is out; all others are
scored exactly from their counts. The first such scores come from one of ``SEED_SHARE`` blocks (any documents give a
valid one), which lie in a folder of their own; then each task raises its own.

Queries are a stated set held against all documents, in blocks of ``QUERY_BYTES``. A task returns ``k`` documents
a query at most, and two ranking steps bring them together, so no query's rows meet in one task before they are few.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import id_and_text, item_blocks, steps, written

TOP = 20
#: A level is reached by so many occurrences.
LEVELS = (1, 2, 3, 5, 9)
HASHES = 3
#: Signature bits for each entry, at least, and the shortest and longest signature.
ROOM, SHORTEST, LONGEST = 8, 1 << 9, 1 << 21
#: Documents, bits and bytes of terms in a block.
BLOCK_DOCS, BLOCK_BITS, BLOCK_BYTES = 4096, 1 << 25, 4 << 20
QUERY_BYTES = 1 << 20
#: Different terms of the queries whose bitmaps are held at a time.
GROUP_TERMS = 4096
SEED_SHARE = 64
#: Documents scored at a time.
SCORED = 256
#: Ranking is done by slices of documents first.
RANK_SLICES = 64

# ASCII letters (lower-cased) and digits and all bytes of other characters make up terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)

INDEX_SCHEMA = (
    "bits int, doc_ids array<bigint>, lengths array<bigint>, most array<bigint>, slices binary, "
    "terms array<binary>, counts array<binary>, seed boolean"
)


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """HASHES signature bits of each term at a level."""
    mixed = (hashes ^ np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.stack([mixed >> np.uint64(64 - 21 * (k + 1)) for k in range(HASHES)]).astype(np.int64) & (bits - 1)


class Block:
    """Documents that become one row of the index."""

    def __init__(self, bits: int):
        self.bits = bits
        self.doc_ids, self.lengths, self.most, self.terms, self.counts, self.set = [], [], [], [], [], []
        self.bytes = 0

    def full(self) -> bool:
        return len(self.doc_ids) >= min(BLOCK_DOCS, BLOCK_BITS // self.bits) or self.bytes >= BLOCK_BYTES

    def row(self) -> pa.RecordBatch:
        wide = -(-len(self.doc_ids) // 8)
        slices = np.zeros((self.bits, wide), dtype=np.uint8)
        for at, own in enumerate(self.set):
            slices[own, at >> 3] |= np.uint8(128 >> (at & 7))
        kinds = {"bits": pa.int32(), "slices": pa.binary(), "seed": pa.bool_()}
        lists = {"terms": pa.binary(), "counts": pa.binary()}
        values = {
            "bits": self.bits,
            "doc_ids": self.doc_ids,
            "lengths": self.lengths,
            "most": self.most,
            "slices": slices.tobytes(),
            "terms": self.terms,
            "counts": self.counts,
            "seed": xxhash.xxh3_64_intdigest(slices) % SEED_SHARE == 0,
        }
        arrays = [pa.array([v], kinds.get(c) or pa.list_(lists.get(c, pa.int64()))) for c, v in values.items()]
        return pa.record_batch(arrays, list(values))


def index(docs: DataFrame) -> DataFrame:
    """The index of all documents with at least one term; see INDEX_SCHEMA. Rows are blocks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Block] = {}
        for batch in steps(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(text)
                if not words:
                    continue
                counts = Counter(words)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), dtype=np.uint64, count=len(counts))
                times = np.fromiter(counts.values(), dtype=np.uint32, count=len(counts))
                reached = [hashes[times >= least] for least in LEVELS]
                entries = sum(map(len, reached))
                bits = min(max(1 << (ROOM * entries - 1).bit_length(), SHORTEST), LONGEST)
                block = open_.setdefault(bits, Block(bits))
                block.doc_ids.append(doc_id)
                block.lengths.append(len(words))
                block.most.append(int(times.max()))
                block.terms.append(b" ".join(counts))
                block.counts.append(times.tobytes())
                own = np.concatenate([places(h, level, bits).reshape(-1) for level, h in enumerate(reached)])
                block.set.append(np.unique(own).astype(np.int32))
                block.bytes += len(block.terms[-1])
                if block.full():
                    yield open_.pop(bits).row()
        for bits in sorted(open_):
            yield open_[bits].row()

    return id_and_text(docs).mapInArrow(build, INDEX_SCHEMA)


class Queries:
    """A block of queries: their terms by number, and groups of queries with the terms they use."""

    def __init__(self, rows: list[tuple[int, str, int]]):
        self.item_ids = [r[0] for r in rows]
        self.times = [r[2] for r in rows]
        self.number: dict[bytes, int] = {}
        self.own = []
        for _, text, _ in rows:
            counts = Counter(self.number.setdefault(t, len(self.number)) for t in terms(text))
            self.own.append((np.array(list(counts), dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)))
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.number), np.uint64, len(self.number))
        self.groups: list[list[int]] = []
        used: set[int] = set()
        for at, (own, _) in enumerate(self.own):
            if not self.groups or len(used.union(own.tolist())) > GROUP_TERMS:
                self.groups.append([])
                used = set()
            self.groups[-1].append(at)
            used.update(own.tolist())
        self.weights = np.zeros(0, dtype=np.int64)
        self.documents = self.total = 0

    def weigh(self, documents: int, total: int, found: dict[int, int]) -> None:
        """Weights from the number of documents, of all their terms, and of documents with each term."""
        self.documents, self.total = documents, total
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(k, 0) + 1))) for k in range(len(self.number))],
            dtype=np.int64,
        )

    def base(self, lengths: np.ndarray) -> np.ndarray:
        return 12 * (100 - 25 + 25 * lengths * self.documents // self.total)


def factor(times: np.ndarray, base: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + base)


class Best:
    """The ``k`` best documents of each query seen so far, and what another has to reach."""

    def __init__(self, queries: int, k: int, least: np.ndarray | None):
        self.k = k
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in range(queries)]
        self.least = np.ones(queries, dtype=np.int64) if least is None else least.copy()

    def add(self, at: int, scores: np.ndarray, doc_ids: list) -> None:
        good = np.flatnonzero(scores >= self.least[at])
        if not len(good):
            return
        new = [(-int(scores[i]), doc_ids[i] is None, doc_ids[i] or 0) for i in good]
        self.rows[at] = sorted(self.rows[at] + new)[: self.k]
        if len(self.rows[at]) == self.k:
            self.least[at] = max(self.least[at], -self.rows[at][-1][0])


def bounds(queries: Queries, group: list[int], slices: np.ndarray, lengths: np.ndarray, most: np.ndarray) -> np.ndarray:
    """An upper bound of the score of each query of a group (rows) for each document of a block."""
    bits, count = len(slices), len(lengths)
    used = np.unique(np.concatenate([queries.own[at][0] for at in group]))
    base = queries.base(lengths)
    out = np.zeros((len(group), count), dtype=np.int64)
    reached, before = None, np.zeros(count, dtype=np.int64)
    for level in range(len(LEVELS)):
        for row in places(queries.hashes[used], level, bits):
            reached = slices[row] if reached is None else reached & slices[row]
        at_most = np.minimum(LEVELS[level + 1] - 1, most) if level + 1 < len(LEVELS) else most
        now = np.maximum(factor(at_most, base), before)
        marked = np.unpackbits(reached, axis=1, count=count)
        some = reached.any(axis=1)
        for k, at in enumerate(group):
            own, times = queries.own[at]
            rows = np.searchsorted(used, own)
            weights = (times * queries.weights[own])[some[rows]]
            rows = rows[some[rows]]
            if len(rows):
                out[k] += (now - before) * (weights.astype(np.float64) @ marked[rows]).astype(np.int64)
        before = now
    return out


def search_block(queries: Queries, best: Best, row: dict) -> int:
    """Add the best documents of a block; the number of documents scored."""
    doc_ids = row["doc_ids"]
    lengths, most = np.array(row["lengths"]), np.array(row["most"])
    slices = np.frombuffer(row["slices"], dtype=np.uint8).reshape(row["bits"], -1)
    base = queries.base(lengths)
    number = queries.number
    scored = 0
    for group in queries.groups:
        used = np.unique(np.concatenate([queries.own[at][0] for at in group]))
        if not len(used):
            continue
        upper = bounds(queries, group, slices, lengths, most)
        # The most promising documents first, so that what a document has to reach rises early.
        hopeful = np.flatnonzero((upper >= best.least[group][:, None]).any(axis=0))
        hopeful = hopeful[np.argsort(-upper[:, hopeful].max(axis=0), kind="stable")]
        for start in range(0, len(hopeful), SCORED):
            part = hopeful[start : start + SCORED]
            part = part[(upper[:, part] >= best.least[group][:, None]).any(axis=0)]
            times = np.zeros((len(part), len(used)), dtype=np.int64)
            for i, doc in enumerate(part):
                found = [number.get(t, -1) for t in row["terms"][doc].split(b" ")]
                found = np.array(found)
                known = np.flatnonzero(found >= 0)
                at = np.searchsorted(used, found[known])
                inside = used[np.minimum(at, len(used) - 1)] == found[known]
                counts = np.frombuffer(row["counts"][doc], dtype=np.uint32)
                times[i, at[inside]] = counts[known[inside]]
            scored += len(part)
            for k, at in enumerate(group):
                docs = np.flatnonzero(upper[k, part] >= best.least[at])
                if not len(docs):
                    continue
                own, repeats = queries.own[at]
                own_times = times[np.ix_(docs, np.searchsorted(used, own))]
                factors = factor(own_times, base[part[docs]][:, None])
                scores = factors @ (repeats * queries.weights[own])
                best.add(at, scores, [doc_ids[d] for d in part[docs]])
    return scored


def best_rows(blocks: DataFrame, queries, k: int, least: np.ndarray | None) -> DataFrame:
    """``query, doc_id, score``: at most ``k`` rows a task and query; the best ``k`` of all are among them."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = queries.value
        best = Best(len(held.own), k, least)
        for batch in batches:
            for i in range(batch.num_rows):
                search_block(held, best, batch.slice(i, 1).to_pylist()[0])
        rows = [(at, None if null else doc_id, -score) for at, own in enumerate(best.rows) for score, null, doc_id in own]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "doc_id", "score"])

    return blocks.mapInArrow(search, "query int, doc_id bigint, score bigint")


def document_counts(blocks: DataFrame, queries) -> DataFrame:
    """``term, n``: the number of documents with each term of the queries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = queries.value.number
        found = np.zeros(len(number) + 1, dtype=np.int64)
        for batch in batches:
            for own in batch.column(0):
                for doc in own.as_py():
                    found[[number.get(t, -1) for t in doc.split(b" ")]] += 1
        used = np.flatnonzero(found[:-1])
        yield pa.record_batch([pa.array(used), pa.array(found[used])], ["term", "n"])

    return blocks.select("terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query with their rank, by slices of documents first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(RANK_SLICES))
    some = rows.withColumn("part", part).withColumn("nth", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    some = some.where(F.col("nth") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores for each row of ``items``.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII; null has none. The
    score sums over the item's terms, repeats included, weight * (10^9 * tf div (1000 * tf + 12 * m)), where the weight
    is floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + 25 * n * N div L. Scores are above 0; equal ones are
    ordered by doc_id, null last. Repeated documents are ranked each, repeated items give their rows each. Items or
    documents without terms give no rows, and so do empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    blocks = written(index(docs), "search-index", ("seed",))
    lengths = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)
    documents, total = blocks.agg(F.sum(F.size("doc_ids")), F.sum(lengths)).first()
    out = None
    for block in item_blocks(items, query_bytes):
        held = Queries(block)
        counting = spark.sparkContext.broadcast(held)
        if documents:
            held.weigh(documents, total, dict(map(tuple, document_counts(blocks, counting).collect())))
        shared = spark.sparkContext.broadcast(held)
        least = np.ones(len(block), dtype=np.int64)
        for at, _, score, *_, rank in ranked(best_rows(blocks.where("seed"), shared, k, None), k).collect():
            if rank == k:
                least[at] = max(score, 1)
        top = ranked(best_rows(blocks, shared, k, least), k)
        about = [(at, item_id, times) for at, (item_id, times) in enumerate(zip(held.item_ids, held.times, strict=True))]
        about = spark.createDataFrame(about, "query int, item_id bigint, times bigint")
        rows = top.join(F.broadcast(about), "query").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        rows = rows.select("item_id", "rank", "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return out
