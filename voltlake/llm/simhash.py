"""Operator 6: SimHash near-duplicates by a binary trie self-join.

The distinct fingerprints form a binary trie. Pairs of trie nodes are traversed together from the top:
each step goes to the children of both nodes, adds a differing bit, and drops the pair once the bits
exceed the budget. A sorted array is the trie: a node is a range of it, and a binary search splits the
range at the next bit. Small node pairs are compared outright.

The first ``depth`` levels are traversed by Spark: each pair of prefixes within the budget is a unit of
work, and a fingerprint is sent to the units of its prefix. The depth grows with the number of
fingerprints so that a prefix has about ``NODE`` of them, and a fuller prefix is split into blocks that
are paired with each other, so a unit is bounded whatever the distribution. A unit sends back a spanning
forest of its links, never more rows than it has fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.llm.common import fresh, id_and_text, steps, written
from voltlake.llm.components import components

WORDS = 3
SEED = 42
MAX_BITS = 3
NODE = 1 << 20
LEAST_DEPTH = 4
MOST_DEPTH = 16
#: Node pairs with up to so many fingerprint pairs are compared outright.
LEAF_PAIRS = 64
FRONTIER = 1 << 18


def fingerprint(text: str, words: int = WORDS) -> int:
    """64 bits, each set if it is set in more than half of the hashes of the word shingles."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 255 * 256):
        block = hashes[start : start + 255 * 256].astype("<u8").view(np.uint8)
        bits = np.unpackbits(block, bitorder="little").reshape(-1, 64)
        for k in range(0, len(bits), 255):
            ones += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    set_bits = np.flatnonzero(2 * ones > len(hashes))
    return sum(1 << int(b) for b in set_bits)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as bigint) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            values = [signed(fingerprint(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(compute, "doc_id bigint, fp bigint")


def similar_pairs_forest(
    prints: DataFrame, max_bits: int = MAX_BITS, node: int = NODE, least_depth: int = LEAST_DEPTH
) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fp`` with at most ``max_bits`` differing bits.

    ``prints`` has one row for each fingerprint. The links are a spanning forest of each unit of work: two
    fingerprints within the budget are always connected, through others that are linked in turn.
    """
    total = prints.count()
    depth = max(least_depth, min(MOST_DEPTH, math.ceil(math.log2(max(total, 1) / node)) if total > node else 0))
    shift = 64 - depth
    prefix = F.shiftrightunsigned("fp", shift)
    # At most 2**MOST_DEPTH rows, whatever the data.
    counts = {r[0]: r[1] for r in prints.groupBy(prefix.alias("p")).agg(F.count("*")).collect()}
    # Block numbers have 15 bits; beyond that, blocks are larger.
    node = max(node, -(-max(counts.values(), default=0) // 0x7FFF))
    blocks = np.zeros(1 << depth, dtype=np.int64)
    for p, n in counts.items():
        blocks[p] = -(-n // node)
    masks = np.array(
        [sum(1 << b for b in bits) for k in range(max_bits + 1) for bits in combinations(range(depth), k)]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each fingerprint to the units of its prefix and block."""
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            own = (values >> np.uint64(shift)).astype(np.int64)
            block = (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64)
            block %= np.maximum(blocks[own], 1)
            groups = np.lexsort((block, own))
            values, own, block = values[groups], own[groups], block[groups]
            new = np.flatnonzero((np.diff(own) != 0) | (np.diff(block) != 0)) + 1
            bounds = np.concatenate([[0], new, [len(own)]]) if len(own) else np.zeros(1, dtype=int)
            units, sides, packed = [], [], []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                mine = (int(own[lo]), int(block[lo]))
                data = values[lo:hi].tobytes()
                for q in (int(m) ^ mine[0] for m in masks):
                    for other in ((q, j) for j in range(blocks[q])):
                        first, second = min(mine, other), max(mine, other)
                        units.append(first[0] << 47 | second[0] << 31 | first[1] << 15 | second[1])
                        sides.append(int(mine != first))
                        packed.append(data)
            yield pa.record_batch(
                [pa.array(units, pa.int64()), pa.array(sides, pa.int32()), pa.array(packed, pa.binary())],
                ["unit", "side", "packed"],
            )

    def traverse(table: pa.Table) -> pa.Table:
        sides = np.array(table["side"].to_pylist())
        packed = table["packed"].to_pylist()
        parts = [
            np.sort(np.frombuffer(b"".join(x for x, s in zip(packed, sides, strict=True) if s == side), np.uint64))
            for side in (0, 1)
        ]
        unit = table["unit"][0].as_py()
        alone = (unit >> 47, unit >> 15 & 0xFFFF) == (unit >> 31 & 0xFFFF, unit & 0x7FFF)
        nodes, roots = forest(parts[0], parts[0] if alone else parts[1], max_bits, alone)
        return pa.table({"a": pa.array(nodes.view(np.int64)), "b": pa.array(roots.view(np.int64))})

    return (
        prints.select("fp")
        .repartitionByRange("fp")
        .mapInArrow(deal, "unit bigint, side int, packed binary")
        .groupBy("unit")
        .applyInArrow(traverse, "a bigint, b bigint")
    )


def forest(a: np.ndarray, b: np.ndarray, max_bits: int, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Trie join of two sorted arrays (of one with itself if ``alone``): each linked value and its root."""
    values = a if alone else np.concatenate([a, b])
    parent = np.arange(len(values))
    offset = 0 if alone else len(a)
    if len(a) and len(b):
        start = np.zeros(1, dtype=np.int64)
        stack = [(64, start, start + len(a), start, start + len(b))]
        while stack:
            stack += _descend(*stack.pop(), a, b, offset, max_bits, alone, parent)
    parent = _roots(parent)
    linked = np.flatnonzero(parent != np.arange(len(values)))
    return values[linked], values[parent[linked]]


def _descend(bits, a_lo, a_hi, b_lo, b_hi, a, b, offset, max_bits, alone, parent) -> list[tuple]:
    """Next level of a chunk of node pairs with ``bits`` bits below them; compares the small ones."""
    while len(a_lo):
        # Differing bits so far are those of any two members above the bits still to come.
        small = ((a_hi - a_lo) * (b_hi - b_lo) <= LEAF_PAIRS) | (bits == 0)
        if small.any():
            _compare(a_lo[small], a_hi[small], b_lo[small], b_hi[small], a, b, offset, max_bits, parent)
            a_lo, a_hi, b_lo, b_hi = (x[~small] for x in (a_lo, a_hi, b_lo, b_hi))
            if not len(a_lo):
                break
        bits -= 1
        bit = np.uint64(bits)
        one = np.uint64(1)
        a_mid = np.searchsorted(a, (a[a_lo] >> bit | one) << bit)
        b_mid = np.searchsorted(b, (b[b_lo] >> bit | one) << bit)
        a_mid, b_mid = np.clip(a_mid, a_lo, a_hi), np.clip(b_mid, b_lo, b_hi)
        children = [(a_lo, a_mid, b_lo, b_mid), (a_mid, a_hi, b_mid, b_hi), (a_lo, a_mid, b_mid, b_hi)]
        mirrored = (a_mid, a_hi, b_lo, b_mid)
        if alone:  # of a node with itself, one of the mixed pairs mirrors the other
            distinct = a_lo != b_lo
            mirrored = tuple(x[distinct] for x in mirrored)
        children.append(mirrored)
        a_lo, a_hi, b_lo, b_hi = (np.concatenate(x) for x in zip(*children, strict=True))
        some = (a_hi > a_lo) & (b_hi > b_lo)
        a_lo, a_hi, b_lo, b_hi = (x[some] for x in (a_lo, a_hi, b_lo, b_hi))
        cost = np.bitwise_count((a[a_lo] ^ b[b_lo]) >> bit)
        within = cost <= max_bits
        a_lo, a_hi, b_lo, b_hi = (x[within] for x in (a_lo, a_hi, b_lo, b_hi))
        if len(a_lo) > FRONTIER:
            half = len(a_lo) // 2
            return [
                (bits, a_lo[:half], a_hi[:half], b_lo[:half], b_hi[:half]),
                (bits, a_lo[half:], a_hi[half:], b_lo[half:], b_hi[half:]),
            ]
    return []


def _compare(a_lo, a_hi, b_lo, b_hi, a, b, offset, max_bits, parent) -> None:
    """Links between the members of node pairs, into the union-find ``parent``."""
    for k in range(0, len(a_lo), 1 << 15):
        lo, hi, low, high = (x[k : k + (1 << 15)] for x in (a_lo, a_hi, b_lo, b_hi))
        wide = high - low
        count = (hi - lo) * wide
        pair = np.repeat(np.arange(len(lo)), count)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        x = lo[pair] + nth // wide[pair]
        y = low[pair] + nth % wide[pair]
        near = np.bitwise_count(a[x] ^ b[y]) <= max_bits
        unite(parent, x[near], y[near] + offset)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def unite(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Union of the pairs, vectorised; parents are never larger than their children."""
    while len(x):
        x, y = find(parent, x), find(parent, y)
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = up


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Fingerprints of lower-cased (A-Z) word shingles; texts without words (null, empty, white space) have
    fingerprint zero and link like any other. component_id is the smallest doc_id over all rows that can be
    reached by links of at most ``max_bits`` bits, null if none has one. Repeated rows and doc_ids are rows
    like others. An empty table gives no rows. Other columns are not read.
    """
    prints = written(fingerprints(docs, words), "prints")
    labels = _labels(prints.select("fp", F.col("doc_id").alias("pick")), max_bits)
    return prints.join(labels, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that of the smallest doc_id.

    Of several rows with that doc_id the first in scan order stays, and so in a component without doc_ids.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    at = docs.columns.index("text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, at):
            values = [signed(fingerprint(t or "", words)) for t in batch.column(at).to_pylist()]
            names = [*batch.schema.names, fp]
            yield pa.record_batch([*batch.columns, pa.array(values, pa.int64())], names)

    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    base = docs.mapInArrow(compute, schema).withColumn(row, F.monotonically_increasing_id())
    base = written(base, "near-duplicates")
    slim = base.select(
        F.col(fp).alias("fp"),
        F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row).alias("row")).alias("pick"),
    )
    dropped = (
        slim.join(_labels(slim, max_bits), "fp")
        .where("pick.row <> least.row")
        .select(F.col("pick.row").alias(row))
    )
    return base.join(dropped, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def _labels(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp`` and ``least``, the smallest ``pick`` over its component, of rows with ``fp`` and ``pick``."""
    classes = written(rows.groupBy("fp").agg(F.min("pick").alias("first")), "print-classes")
    roots = written(components(similar_pairs_forest(classes, max_bits)), "print-roots")
    members = roots.select(F.col("node").alias("fp"), "root").union(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    rooted = classes.join(members, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select("fp", "least")
