"""Operator 10: language identification by prediction by partial matching.

For every language a context tree of up to ``ORDER`` preceding bytes is counted over a bounded sample of
labelled rows and then frozen. A byte costs its code length in the longest context that was seen: with
``n`` bytes seen there, ``q`` of them different, a byte seen ``c`` times has probability c / (n + q), and the
escape to the next shorter context q / (n + q) (method C). Below the empty context all bytes are alike.
A text's language is the one with the shortest code.

The trees of all languages are kept as sorted arrays. Every n-gram of the sample has its code lengths
computed beforehand, so a known byte costs one lookup; the others walk down the contexts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.llm.common import fresh, hash_sample, steps

ORDER = 3
#: Labelled rows of each language that the trees are counted over.
SAMPLE_ROWS = 400
#: A text that costs more bits for each byte than this in every language is in none of them. Prose takes
#: 2 to 3, short texts full of numbers and capitals up to 8, a script that was never seen about 20.
MOST_BITS = 12.0
UNDETERMINED = "und"
FOLDS, HELD_OUT = 3, 1

MAYBE_LETTER = re.compile(r"[^\W\d_]")
PAD = b"\n" * ORDER
SLICE = 1 << 17
#: Largest index table, 64 MB.
TABLE_CELLS = 1 << 24


def has_letter(text: str) -> bool:
    """Whether any character is a letter; the pattern also takes signs such as a superscript two."""
    return any(m[0].isalpha() for m in MAYBE_LETTER.finditer(text))


def fold() -> Column:
    """Rows with remainder ``HELD_OUT`` are never learned from; a null doc_id counts as an empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS


class ContextTrees:
    """Frozen byte statistics of several languages."""

    def __init__(self, counts: dict[str, dict[int, int]]):
        """``counts``: for each language how often each n-gram of ORDER + 1 bytes (big-endian) occurs."""
        self.languages = sorted(counts)
        self.levels = []
        for order in range(ORDER + 1):
            per_language = []
            for language in self.languages:
                grams = np.array(sorted(counts[language]), dtype=np.int64)
                n = np.array([counts[language][int(g)] for g in grams], dtype=np.float64)
                per_language.append(_level(grams & (1 << 8 * (order + 1)) - 1, n))
            self.levels.append(per_language)
        known = np.unique(np.concatenate([np.empty(0, np.int64), *(
            np.array(list(c), dtype=np.int64) for c in counts.values()
        )]))
        self.known = known.astype(np.uint32)
        self.known_bits = np.concatenate([np.zeros((1, len(self.languages))), self._walk(known)])
        self._index()

    def _index(self) -> None:
        """Row of ``known_bits`` for two pairs of bytes, by their ranks among the pairs that occur.

        Row 0 is for n-grams that are not known. With more pairs than TABLE_CELLS allows, which only many
        scripts together have, rows are searched instead.
        """
        first, second = self.known >> 16, self.known & 0xFFFF
        self.ranks = [np.zeros(1 << 16, dtype=np.int64) for _ in range(2)]
        for ranks, pairs in zip(self.ranks, (first, second), strict=True):
            used = np.unique(pairs)
            ranks[used] = np.arange(1, len(used) + 1)
        self.wide = int(self.ranks[1].max()) + 1
        cells = (int(self.ranks[0].max()) + 1) * self.wide
        self.table = None
        if cells <= TABLE_CELLS:
            self.table = np.zeros(cells, dtype=np.int32)
            at = self.ranks[0][first] * self.wide + self.ranks[1][second]
            self.table[at] = np.arange(1, len(self.known) + 1)

    def _walk(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each n-gram in each language."""
        bits = np.zeros((len(grams), len(self.languages)))
        for column in range(len(self.languages)):
            total = np.zeros(len(grams))
            open_ = np.ones(len(grams), dtype=bool)
            for order in range(ORDER, -1, -1):
                keys, seen, contexts, sizes, kinds = self.levels[order][column]
                gram = grams & (1 << 8 * (order + 1)) - 1
                c, n = _find(keys, seen, gram), _find(contexts, sizes, gram >> 8)
                q = _find(contexts, kinds, gram >> 8)
                hit, escape = open_ & (c > 0), open_ & (c == 0) & (n > 0)
                total[hit] += np.log2((n[hit] + q[hit]) / c[hit])
                total[escape] += np.log2((n[escape] + q[escape]) / q[escape])
                open_ &= ~hit
            total[open_] += 8
            bits[:, column] = total
        return bits

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language. Unknown n-grams of all texts are walked down together."""
        total = np.zeros((len(texts), len(self.languages)))
        owners, grams, times = [], [], []
        for k, text in enumerate(texts):
            for start in range(0, len(text), SLICE):
                before = (PAD + text[max(0, start - ORDER) : start])[-ORDER:]
                bits, other, n = self._slice_bits(before + text[start : start + SLICE])
                total[k] += bits
                owners.append(np.full(len(other), k))
                grams.append(other)
                times.append(n)
        if any(map(len, grams)):
            distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
            bits = self._walk(distinct)[at] * np.concatenate(times)[:, None]
            np.add.at(total, np.concatenate(owners), bits)
        return total

    def _slice_bits(self, padded: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits of the known n-grams; the other ones and how often they occur."""
        data = np.frombuffer(padded, dtype=np.uint8).astype(np.uint16)
        pairs = data[:-1] << np.uint16(8) | data[1:]
        first, second = pairs[:-2], pairs[2:]
        rows = self._rows(first, second)
        missing = np.flatnonzero(rows == 0)
        grams = first[missing].astype(np.int64) << 16 | second[missing]
        return np.ones(len(rows)) @ self.known_bits[rows], *np.unique(grams, return_counts=True)

    def _rows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[self.ranks[0][first] * self.wide + self.ranks[1][second]]
        if not len(self.known):
            return np.zeros(len(first), dtype=np.int64)
        grams = first.astype(np.uint32) << np.uint32(16) | second
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, at + 1, 0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, its share of the probability (0 to 1), and the bits for each byte, of each text."""
        found = [(UNDETERMINED, 0.0, 0.0)] * len(texts)
        judged = [k for k, text in enumerate(texts) if self.languages and text and has_letter(text)]
        data = [texts[k].encode() for k in judged]
        for k, own, bits in zip(judged, data, self.code_lengths(data), strict=True):
            best = int(np.argmin(bits))
            share = 1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()
            found[k] = (self.languages[best], float(share), float(bits[best] / len(own)))
        return found


def _level(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted n-grams with counts; their contexts with all counts and the number of different bytes."""
    keys, at = np.unique(grams, return_inverse=True)
    seen = np.bincount(at, weights=n, minlength=len(keys))
    contexts, back = np.unique(keys >> 8, return_inverse=True)
    sizes = np.bincount(back, weights=seen, minlength=len(contexts))
    kinds = np.bincount(back, minlength=len(contexts)).astype(np.float64)
    return keys, seen, contexts, sizes, kinds


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ContextTrees:
    """Trees over at most ``sample_rows`` labelled rows of each language, whole texts.

    Rows whose crc32(doc_id) leaves the remainder HELD_OUT, or whose text or lang is null, are not used. The
    sample of a language has the smallest hashes of doc_id and text, so it does not
    depend on the order of rows; rows without or with the same doc_id are rows like others. The n-gram counts, which
    the sample bounds for each language, come to the driver.
    """
    usable = (fold() != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = docs.where(usable).select("lang", "text", "doc_id", F.xxhash64("text").alias("text_mark"))
    sample = hash_sample(rows, "lang", sample_rows, "doc_id", "text_mark").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(PAD + text.encode(), dtype=np.uint8).astype(np.int64)
                size = len(data) - ORDER
                grams = sum(data[k : k + size] << 8 * (ORDER - k) for k in range(ORDER + 1))
                keys, n = np.unique(grams, return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * len(keys)), pa.array(keys, pa.int64()), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )

    rows = sample.mapInArrow(count, "lang string, gram bigint, n bigint")
    counts: dict[str, dict[int, int]] = {}
    for r in rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    return ContextTrees(counts)


def identify(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``docs`` with ``lang_pred, score, bits``: language, share of the probability, bits for each byte.

    Only ``text`` is looked at. A text that is null or has no letter is ``und`` with score 0, and so is every
    text if there was nothing to learn from. Each row is judged alone, so repeated rows are alike. Names that
    ``docs`` already has get an underscore.
    """
    at = docs.columns.index("text")
    names = [fresh(docs, n) for n in ("lang_pred", "score", "bits")]
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in steps(batches, at):
            found = model.predict(batch.column(at).to_pylist())
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.record_batch([*batch.columns, *columns], [*batch.schema.names, *names])

    types = (T.StringType(), T.DoubleType(), T.DoubleType())
    added = [T.StructField(n, t) for n, t in zip(names, types, strict=True)]
    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, *added]))


def predictions(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row (:func:`learn`, :func:`identify`)."""
    trees = learn(docs, sample_rows)
    return identify(docs.select("doc_id", "text"), trees).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )


def drop_unidentified(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, most_bits: float = MOST_BITS
) -> DataFrame:
    """The rows of ``docs`` in some language: not ``und``, and at most ``most_bits`` bits for each byte."""
    names = [fresh(docs, n) for n in ("lang_pred", "bits")]
    rows = identify(docs, learn(docs, sample_rows))
    kept = (F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) <= most_bits)
    return rows.where(kept).select(*[f"`{c}`" for c in docs.columns])
