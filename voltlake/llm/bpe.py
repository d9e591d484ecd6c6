"""Operator 1: byte-level BPE encoding by tree concatenation, and decoding.

A text is halved until its pieces have at most ``leaf_chars`` characters. Pieces are encoded on their own,
and two neighbours are joined by encoding a window around the cut again. The window grows until both of its
edges agree with what lies outside:

- An edge between a printable ASCII character and ASCII white space ends a pre-token in any context, so
  nothing beyond it can change.
- An edge inside a run of letters (or of digits) splits a pre-token. There the token inside the window has
  to be the one that the piece has at that place. Byte-pair encoding gives the same tokens for the whole
  exactly if every pair of neighbouring tokens is the encoding of its own text, and with an equal token at
  the edge each pair was checked either by the window or by the piece.

A window reaches at least as far beyond the cut as a special token is long, so one that straddles the cut
is seen. Without an agreeing edge the window ends up as the whole of both halves, which is exact as well.

Texts of up to ``spread_chars`` characters are joined where they are read. The pieces of longer ones are
encoded by different tasks and gathered again by text, which no result about a whole text can avoid.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import STEP_ROWS, id_and_text, steps

LEAF_CHARS = 4096
SPREAD_CHARS = 65536
FIRST_WINDOW = 8

# How byte-level BPE splits text, and the bytes it writes as themselves.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))

WHITE = frozenset(b" \t\n\r\x0b\x0c")
PRINTABLE = frozenset(range(0x21, 0x7F))


class Codec:
    """The vocabulary of a byte-level BPE ``tokenizer.json``: encodes pieces, knows the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        others = [b for b in range(256) if b not in PLAIN_BYTES]
        byte_of = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        for merge, expected in zip(spec["model"]["merges"], range(256, len(ranks)), strict=True):
            pair = merge.split(" ") if isinstance(merge, str) else merge
            if vocab["".join(pair)] != expected:
                raise ValueError("Ids of merged tokens have to follow the order of the merges")
        self.special = special
        self.margin = max((len(t) for t in special), default=0)
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.bytes_of[i] = token
        self.lengths = np.array([len(b) for b in self.bytes_of])
        self.opens_char = np.array([not b or not 0x80 <= b[0] < 0xC0 for b in self.bytes_of])
        self._engine = tiktoken.Encoding(
            path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special
        )

    def piece(self, text: str, special: bool = True) -> np.ndarray:
        """Ids of a text encoded in one go; ``special`` tokens' strings are their ids, else plain text."""
        allowed = "all" if special else set()
        return self._engine.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS, special: bool = True) -> np.ndarray:
        """Ids of a text by tree concatenation."""
        if len(text) <= leaf_chars:
            return self.piece(text, special)
        return self.join([(p.encode(), self.piece(p, special)) for p in halves(text, leaf_chars)], special)

    def join(self, nodes: list[tuple[bytes, np.ndarray]], special: bool = True) -> np.ndarray:
        """Ids of neighbouring pieces, joined pairwise level by level."""
        while len(nodes) > 1:
            pairs = [self._pair(*nodes[i], *nodes[i + 1], special) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[len(pairs) * 2 :]
        return nodes[0][1]

    def _pair(
        self, a: bytes, left: np.ndarray, b: bytes, right: np.ndarray, special: bool
    ) -> tuple[bytes, np.ndarray]:
        size = FIRST_WINDOW
        while True:
            i, start, hard_start = self._left_edge(a, left, size)
            j, end, hard_end = self._right_edge(b, right, size)
            window = self.piece((a[start:] + b[:end]).decode(), special)
            same_start = hard_start or window[0] == left[i]
            same_end = hard_end or window[-1] == right[j - 1]
            if same_start and same_end:
                return a + b, np.concatenate([left[:i], window, right[j:]])
            size *= 2

    def _left_edge(self, data: bytes, ids: np.ndarray, size: int) -> tuple[int, int, bool]:
        """Token, byte position, and whether it is a pre-token's end: at least ``size`` tokens from the cut."""
        i, at = len(ids), len(data)
        while i > 0:
            i -= 1
            at -= int(self.lengths[ids[i]])
            if len(ids) - i >= size and len(data) - at >= self.margin and self.opens_char[ids[i]]:
                kind = edge(data, at)
                if kind:
                    return i, at, kind == "hard"
        return 0, 0, True

    def _right_edge(self, data: bytes, ids: np.ndarray, size: int) -> tuple[int, int, bool]:
        at = 0
        for j in range(1, len(ids)):
            at += int(self.lengths[ids[j - 1]])
            if j >= size and at >= self.margin and self.opens_char[ids[j]]:
                kind = edge(data, at)
                if kind:
                    return j, at, kind == "hard"
        return len(ids), len(data), True


def edge(data: bytes, at: int) -> str:
    """``hard`` between printable ASCII and white space, ``soft`` within letters or digits, else empty."""
    if at == 0:
        return "hard"
    if data[at] in WHITE:
        return "hard" if data[at - 1] in PRINTABLE else ""
    before = data[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
    after = data[at : at + 4].decode("utf-8", "ignore")[:1]
    if before.isalpha() and after.isalpha() or before.isdecimal() and after.isdecimal():
        return "soft"
    return ""


def halves(text: str, leaf_chars: int) -> list[str]:
    """Pieces of equal length, a power of two many, none longer than ``leaf_chars``."""
    count = 1
    while count * leaf_chars < len(text):
        count *= 2
    cuts = [len(text) * k // count for k in range(count + 1)]
    return [text[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(
    docs: DataFrame,
    tokenizer: str,
    leaf_chars: int = LEAF_CHARS,
    spread_chars: int = SPREAD_CHARS,
) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every row; ``tokenizer`` is the path of a tokenizer.json.

    The strings of special tokens become their ids, none are added. Null and empty texts have no ids.
    Rows are independent: repeated rows and null doc_ids give a row each. The result has its own columns
    only, so other columns of ``docs`` may have any name.
    """
    rows = id_and_text(docs)
    is_long = F.char_length("text") > spread_chars

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in steps(batches):
            yield _id_rows(batch.column(0), [own.encode(t, leaf_chars) for t in batch.column(1).to_pylist()])

    short = rows.where(~is_long).mapInArrow(here, "doc_id bigint, ids array<int>")
    return short.unionByName(_spread(rows.where(is_long), tokenizer, leaf_chars, spread_chars))


def _id_rows(doc_ids: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.concatenate([np.empty(0, dtype=np.int32), *ids]).astype(np.int32)
    return pa.record_batch([doc_ids, pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "ids"])


def _spread(rows: DataFrame, tokenizer: str, leaf_chars: int, spread_chars: int) -> DataFrame:
    """Long texts: pieces encoded apart, then gathered by text and joined."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Equal rows of a partition are told apart by counting them, so a repeated task names them alike.
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()
        for batch in steps(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name = f"{doc_id} {hashlib.sha256(text.encode()).hexdigest()}"
                key = f"{name} {part} {seen[name]}"
                seen[name] += 1
                pieces = halves(text, spread_chars)
                count = len(pieces)
                yield pa.record_batch(
                    [
                        pa.array([key] * count),
                        pa.array([doc_id] * count, pa.int64()),
                        pa.array(range(count), pa.int32()),
                        pa.array(pieces),
                    ],
                    ["key", "doc_id", "at", "text"],
                )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in steps(batches):
            ids = [own.encode(t, leaf_chars).astype("<u4").tobytes() for t in batch.column(3).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    def gather(table: pa.Table) -> pa.Table:
        own = codec(tokenizer)
        table = table.sort_by("at")
        nodes = [
            (text.encode(), np.frombuffer(ids, dtype="<u4"))
            for text, ids in zip(table["text"].to_pylist(), table["ids"].to_pylist(), strict=True)
        ]
        doc_id = table["doc_id"].combine_chunks()[:1]
        return pa.Table.from_batches([_id_rows(doc_id, [own.join(nodes)])])

    schema = "key string, doc_id bigint, at int, text string"
    return (
        rows.mapInArrow(cut, schema)
        .repartition("key", "at")
        .mapInArrow(pieces, f"{schema}, ids binary")
        .groupBy("key")
        .applyInArrow(gather, "doc_id bigint, ids array<int>")
    )


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``, to ``doc_id`` and ``ids``. No ids give an empty text."""
    rows = encoded.select("doc_id", "ids")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                step = batch.slice(start, STEP_ROWS)
                out = [own.decode(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in step.column(1)]
                yield pa.record_batch([*step.columns, pa.array(out, pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(texts, "doc_id bigint, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token counts and checksums of decoded rows."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
