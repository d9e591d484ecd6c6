"""Operator 13: dropping lines that many documents share.

Every line long enough is reduced to a 128-bit hash of its key. The rows (hash, document, position) are
range-partitioned and sorted by hash, then by document from the largest, then by position, so the first
document of a hash is the one that keeps its lines. A task streams through its range: it counts documents until
``min_docs`` are seen and from there on passes on every position but those of the first document. It holds no
more than the rows of ``min_docs - 1`` documents.

The document is part of the range, so a line of a third of all documents is spread over many tasks. Only the
first and the last hash of a task can go on in another one: tasks report these two, the reports are put
together (two rows a task), and positions that had to wait are decided by them. Positions are gathered by
document into compressed bitmaps of lines to keep; texts move only when the bitmaps are applied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import id_and_text, steps, written

MIN_CHARS = 40
MIN_DOCS = 5
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A document without doc_id counts as one with the smallest bigint.
NO_ID = -(1 << 63)

KEY = ["h1", "h2"]
ROW = [*KEY, "doc", "text_key", "pos"]
#: What a task says about a row: drop it; wait for the report on its hash; or it is such a report.
DROP, WAIT, REPORT = 0, 1, 2
STREAM_SCHEMA = "kind int, h1 bigint, h2 bigint, doc bigint, text_key bigint, pos int, docs bigint, last bigint"


def document_key(rows: DataFrame) -> DataFrame:
    """``doc`` and ``text_key``: rows with the same doc_id and text lose the same lines."""
    return rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text_key", F.xxhash64("text"))


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, UPPER.lower())


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, doc, text_key, pos`` of every line whose key has at least ``min_chars`` code points."""
    lines = document_key(id_and_text(docs)).select("doc", "text_key", F.posexplode(F.split("text", "\n", -1)))
    keyed = lines.select("doc", "text_key", "pos", line_key(F.col("col")).alias("key")).where(
        F.length("key") >= min_chars
    )
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_key", "pos")


class Open:
    """The hash a task is in the midst of: its documents so far, and rows that may have to stay."""

    def __init__(self, rows: list[np.ndarray], leading: bool):
        self.key = rows[0][0], rows[1][0]
        self.leading = leading
        self.docs, self.first, self.last = 0, rows[2][0], None
        self.held = [c[:0] for c in rows]

    def add(self, rows: list[np.ndarray]) -> None:
        doc = rows[2]
        self.docs += int((np.diff(doc) != 0).sum()) + (self.last is None or self.last != doc[0])
        self.last = doc[-1]


def streamed(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Verdicts on sorted rows, hash by hash; see DROP, WAIT and REPORT."""
    now: Open | None = None
    for batch in batches:
        rows = [c.to_numpy() for c in batch.columns]
        if not len(rows[0]):
            continue
        now = now or Open(rows, leading=True)
        starts = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        if (rows[0][0], rows[1][0]) != now.key:
            starts = np.concatenate([[0], starts])
        cut = int(starts[0]) if len(starts) else len(rows[0])
        yield from _go_on(now, [c[:cut] for c in rows], min_docs)
        if not len(starts):
            continue
        if now.leading:
            yield _report(now)
        last = int(starts[-1])
        yield from _whole([c[cut:last] for c in rows], starts[:-1] - cut, min_docs)
        tail = [c[last:] for c in rows]
        now = Open(tail, leading=False)
        yield from _go_on(now, tail, min_docs)
    if now is not None:
        yield _verdicts(WAIT, now.held)
        yield _report(now)


def _go_on(now: Open, rows: list[np.ndarray], min_docs: int) -> Iterator[pa.RecordBatch]:
    """More rows of the open hash. The first hash of a task may have begun in another, so its rows wait."""
    if not len(rows[0]):
        return
    now.add(rows)
    if now.leading:
        yield _verdicts(WAIT, rows)
        return
    rows = [np.concatenate(x) for x in zip(now.held, rows, strict=True)]
    if now.docs < min_docs:
        now.held = rows
        return
    now.held = [c[:0] for c in rows]
    yield _verdicts(DROP, [c[rows[2] != now.first] for c in rows])


def _whole(rows: list[np.ndarray], starts: np.ndarray, min_docs: int) -> Iterator[pa.RecordBatch]:
    """Hashes that begin and end here."""
    if not len(starts):
        return
    doc = rows[2]
    sizes = np.diff(np.append(starts, len(doc)))
    new = np.concatenate([[True], np.diff(doc) != 0])
    new[starts] = True
    count = np.cumsum(new)
    documents = count[starts + sizes - 1] - count[starts] + 1
    drop = np.repeat(documents >= min_docs, sizes) & (doc != np.repeat(doc[starts], sizes))
    yield _verdicts(DROP, [c[drop] for c in rows])


def _batch(columns: list) -> pa.RecordBatch:
    types = [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in STREAM_SCHEMA.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _verdicts(kind: int, rows: list[np.ndarray]) -> pa.RecordBatch:
    n = len(rows[0])
    hashes = rows[:2] if kind == WAIT else [[None] * n] * 2
    return _batch([np.full(n, kind, np.int32), *hashes, *rows[2:], [None] * n, [None] * n])


def _report(now: Open) -> pa.RecordBatch:
    return _batch([[REPORT], *([k] for k in now.key), [now.first], [None], [None], [now.docs], [now.last]])


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc, text_key, pos`` of every line to drop."""
    if min_docs < 2:
        raise ValueError("a line of a single document is not repeated")
    lines = written(line_rows(docs, min_chars), "lines")  # sorting reads its input twice
    order = ["h1", "h2", F.desc("doc"), "text_key", "pos"]
    ranges = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    verdicts = written(ranges.mapInArrow(lambda batches: streamed(batches, min_docs), STREAM_SCHEMA), "line-verdicts")
    # Two rows a task. Reports on a hash follow each other by document; one document may end one and begin the next.
    along = Window.partitionBy(*KEY).orderBy(F.desc("doc"), F.desc("last"))
    reports = verdicts.where(F.col("kind") == REPORT).withColumn("before", F.lag("last").over(along))
    shared = F.when(F.col("before") == F.col("doc"), 1).otherwise(0)
    decided = reports.groupBy(*KEY).agg(F.sum(F.col("docs") - shared).alias("n"), F.max("doc").alias("stays"))
    decided = decided.where(F.col("n") >= min_docs).select(*KEY, "stays")
    waiting = verdicts.where(F.col("kind") == WAIT).join(F.broadcast(decided), KEY).where("doc <> stays")
    columns = ["doc", "text_key", "pos"]
    return verdicts.where(F.col("kind") == DROP).select(*columns).union(waiting.select(*columns))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc, text_key, n_dropped, keep``: one row for each text that loses lines.

    ``keep`` is a zstd-compressed bitmap of lines, the first line in the highest bit of the first byte; lines
    beyond its end stay.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            sizes = np.diff(places.offsets.to_numpy())
            packed = []
            for own in np.split(places.flatten().to_numpy(), np.cumsum(sizes)[:-1]):
                keep = np.ones(int(own.max()) + 1, dtype=bool)
                keep[own] = False
                # Lines after the last byte's last bit stay, so its spare bits say the same.
                bits = np.concatenate([keep, np.ones(-len(keep) % 8, dtype=bool)])
                packed.append(zstandard.compress(np.packbits(bits).tobytes(), 1))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.record_batch(columns, ["doc", "text_key", "n_dropped", "keep"])

    places = repeated_lines(docs, min_chars, min_docs).groupBy("doc", "text_key").agg(F.collect_set("pos").alias("places"))
    return places.mapInArrow(pack, "doc bigint, text_key bigint, n_dropped bigint, keep binary")


def kept(text: str, bitmap: bytes) -> str:
    """The lines of ``text`` that stay."""
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zstandard.decompress(bitmap), dtype=np.uint8))
    keep = np.ones(len(lines), dtype=bool)
    keep[: len(bits)] = bits[: len(lines)].astype(bool)
    return "\n".join([lines[k] for k in np.flatnonzero(keep)])


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row, the text without the lines it loses.

    Texts are split at line feeds; null and empty ones are one empty line. A line's key is the line without ASCII
    white space at its ends, A-Z lower-cased. A key of at least ``min_chars`` code points in at least
    ``min_docs`` documents loses all its lines but those of the largest doc_id that has it. Rows with the same
    doc_id are one document; a null doc_id is smaller than any other. ``n_lines`` counts the lines before. An empty
    table gives no rows. Other columns are not read. Keys are told apart by 128 bits of hash.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps([batch]):
                texts = part.column(1).to_pylist()
                bitmaps = part.column(3).to_pylist()
                left = [t if b is None else kept(t, b) for t, b in zip(texts, bitmaps, strict=True)]
                lines = [t.count("\n") + 1 for t in texts]
                columns = [part.column(0), pa.array(left, pa.string()), pa.array(lines, pa.int64()), part.column(2)]
                yield pa.record_batch(columns, ["doc_id", "text", "n_lines", "n_dropped"])

    rows = document_key(id_and_text(docs)).join(keep_bitmaps(docs, min_chars, min_docs), ["doc", "text_key"], "left")
    rows = rows.select("doc_id", "text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")
    return rows.mapInArrow(apply, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")
