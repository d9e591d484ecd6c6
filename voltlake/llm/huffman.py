"""Canonical length-limited Huffman codes over token ids, packed and unpacked with array operations."""

from __future__ import annotations

import numpy as np

#: Longest code: the decoding table has 2**MAX_LENGTH entries.
MAX_LENGTH = 18
#: Tokens between two bit-offset checkpoints of a block.
STRIDE = 256


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Lengths of an optimal prefix code with no code longer than ``limit``; 0 where the count is 0.

    Package-merge (Larmore and Hirschberg, 1990): ``limit`` rounds of pairing the cheapest packages and
    merging them with the symbols. A symbol's code is as long as the number of rounds that choose it.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    rounds = []
    packages = np.empty(0)
    for _ in range(limit):
        weights = np.concatenate([leaves, packages])
        at = np.argsort(weights, kind="stable")
        rounds.append(at < len(leaves))
        weights = weights[at]
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
    # Walk back: the first 2n-2 items of the last round are chosen, and what its packages are made of.
    take = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), dtype=np.int64)
    for is_leaf in reversed(rounds):
        chosen = is_leaf[:take]
        n = int(chosen.sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The codes that follow from the lengths alone: ascending by length, then by symbol."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    steps = lengths[order].astype(np.int64)
    if len(order):
        # In units of the longest code, each code starts where the one before it ends.
        longest = int(steps.max())
        starts = np.concatenate([[0], np.cumsum(1 << (longest - steps))[:-1]])
        codes[order] = (starts >> (longest - steps)).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length for every possible next ``width`` bits."""
    width = int(lengths.max()) if len(lengths) and lengths.max() else 1
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (width - lengths[order].astype(np.int64))
    symbols = np.zeros(1 << width, dtype=np.uint32)
    sizes = np.zeros(1 << width, dtype=np.uint8)
    total = int(spans.sum())
    symbols[:total] = np.repeat(order, spans)
    sizes[:total] = np.repeat(lengths[order], spans)
    return symbols, sizes, width


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """Code bits of a block, and the bit offset of every ``stride``-th token."""
    if not len(ids):
        return b"", np.empty(0, dtype=np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    # Codes are shorter than a 32-bit word, so each touches its own word and at most the next one.
    word, inside = starts >> 5, starts & 31
    wide = codes[ids] << (64 - inside - size).astype(np.uint64)
    words = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint64)
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    at = word[firsts]
    words[at] += np.add.reduceat(wide >> np.uint64(32), firsts)
    words[at + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), firsts)
    data = words.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8]
    return data, starts[::stride]


def unpack(
    data: bytes,
    count: int,
    checkpoints: np.ndarray,
    table: tuple[np.ndarray, np.ndarray, int],
    stride: int = STRIDE,
) -> np.ndarray:
    """The ``count`` tokens of a block: one table lookup per token, at all checkpoints at the same time."""
    symbols, sizes, width = table
    padded = np.frombuffer(data + bytes(16), dtype=np.uint8).astype(np.uint64)
    # 32 bits from each byte on, so that any offset has at least 25 bits at hand.
    view = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    out = np.zeros((stride, len(checkpoints)), dtype=np.uint32)
    at = np.array(checkpoints, dtype=np.int64)
    last = len(view) - 1
    for step in range(min(stride, count)):
        bits = view[np.minimum(at >> 3, last)] >> (32 - width - (at & 7)).astype(np.uint64)
        key = (bits & np.uint64((1 << width) - 1)).astype(np.int64)
        out[step] = symbols[key]
        at += sizes[key]
    return out.T.reshape(-1)[:count]
