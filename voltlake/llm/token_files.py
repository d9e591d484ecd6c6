"""Operator 3: token ids as Huffman-coded binary files.

1. Rows are put in ascending doc_id order over range partitions and encoded. Each partition, one file,
   becomes raw blocks: whole documents up to about ``BLOCK`` ids, longer documents in blocks of their own.
2. Ids are counted over all blocks. The counts (one row for each id of the vocabulary, so bounded by it)
   give a canonical code whose lengths are limited; the lengths alone are stored with the files.
3. Each block is coded on its own, with the bit offset of every 256th id as checkpoints.

The files are Parquet tables under one folder: ``blocks`` (file, block, the documents in it and their
lengths, checkpoints, code bits) and ``code`` (id, code length). Spark's writer commits whole tasks only, so
a lost executor leaves no partial file. Reading decodes any block without another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltlake.llm import huffman
from voltlake.llm.bpe import codec
from voltlake.llm.common import id_and_text, steps, written
from voltlake.sources.staging import new_folder

BLOCK = 65536
END_ID = 0

BLOCK_FIELDS = "file int, block int, start bigint, doc_ids array<bigint>, sizes array<int>, part int, parts int"


def raw_blocks(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Blocks of ids in doc_id order: BLOCK_FIELDS and ``ids`` (little-endian, 2 or 4 bytes each).

    ``start`` counts the ids before the block in its file. The last row of a file has no block but ``counts``, how
    often each id of the vocabulary is in the file. A document longer than a block is alone in
    ``parts`` blocks. Nulls come first; rows with equal doc_id keep scan order.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs).withColumn("at", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("at")]
    rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        kind = id_type(own.size)
        file, number, start = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], dtype=kind)
        doc_ids, held, size = [], [], 0
        total = np.zeros(own.size, dtype=np.int64)

        def row(*values) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([v], t) for v, t in zip(values, RAW_TYPES, strict=True)], RAW_NAMES
            )

        def flush(pieces: list[np.ndarray], part: int, parts: int) -> pa.RecordBatch:
            nonlocal number, start
            ids = np.concatenate(pieces)
            np.add(total, np.bincount(ids, minlength=own.size), out=total)
            sizes = [len(p) for p in pieces]
            out = row(file, number, start, doc_ids, sizes, part, parts, ids.tobytes(), None)
            number, start = number + 1, start + len(ids)
            return out

        for batch in steps(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([own.encode(text).astype(kind), end])
                if held and size + len(ids) > block:
                    yield flush(held, 0, 1)
                    doc_ids, held, size = [], [], 0
                if len(ids) > block:
                    doc_ids = [doc_id]
                    pieces = [ids[k : k + block] for k in range(0, len(ids), block)]
                    for k, piece in enumerate(pieces):
                        yield flush([piece], k, len(pieces))
                    doc_ids = []
                else:
                    doc_ids.append(doc_id)
                    held.append(ids)
                    size += len(ids)
        if held:
            yield flush(held, 0, 1)
        if number:
            yield row(file, number, start, None, None, None, None, None, total.tobytes())

    return rows.select("doc_id", "text").mapInArrow(encode, f"{BLOCK_FIELDS}, ids binary, counts binary")


RAW_NAMES = ["file", "block", "start", "doc_ids", "sizes", "part", "parts", "ids", "counts"]
RAW_TYPES = [
    *[pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32()],
    *[pa.binary()] * 2,
]


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def id_counts(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs; summed by Spark, one row for each id reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_buffer(), dtype=np.int64)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int64()), pa.array(total[found])], ["id", "n"])

    files = blocks.where("counts IS NOT NULL").select("counts")
    rows = files.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in rows.collect():
        counts[row["id"]] = row["n"]
    return counts


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Encode ``docs`` into token files under ``folder``. Null and empty texts are an end id only.

    An empty table gives files without blocks. Repeated rows and doc_ids are documents like others.
    """
    spark = docs.sparkSession
    vocabulary = codec(tokenizer).size
    raw = written(raw_blocks(docs, tokenizer, end_id, block), "raw-blocks")
    lengths = huffman.code_lengths(id_counts(raw, vocabulary))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in used], "id int, length int"
    ).coalesce(1).write.parquet(f"{folder}/code")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = np.frombuffer(row.column(7)[0].as_buffer(), id_type(vocabulary))
                bits, checkpoints = huffman.pack(ids, codes, lengths)
                yield pa.record_batch(
                    [*row.columns[:7], pa.array([checkpoints.tolist()], pa.list_(pa.int32())), pa.array([bits])],
                    [*RAW_NAMES[:7], "checkpoints", "bits"],
                )

    coded = raw.where("ids IS NOT NULL").drop("counts").mapInArrow(code, f"{BLOCK_FIELDS}, checkpoints array<int>, bits binary")
    coded.write.parquet(f"{folder}/blocks")


def read_code(spark: SparkSession, folder: str) -> np.ndarray:
    """Code lengths by id; one row for each used id of the vocabulary."""
    rows = spark.read.parquet(f"{folder}/code").collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.uint8)
    for row in rows:
        lengths[row["id"]] = row["length"]
    return lengths


def read_parts(spark: SparkSession, folder: str, which: str = "true") -> DataFrame:
    """Documents, or their parts, as they lie in the blocks: PART_FIELDS.

    ``doc`` is the block a document starts in, ``part`` of ``parts`` its blocks, ``start`` in its file.
    Only blocks that meet the condition ``which`` are decoded.
    """
    lengths = read_code(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                file, block, start, doc_ids, sizes, part, parts, checkpoints, bits = (
                    c[k].as_py() for c in batch.columns
                )
                ids = huffman.unpack(bits, sum(sizes), np.array(checkpoints, dtype=np.int64), table)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                n = len(sizes)
                pieces = [ids[x:y].astype("<u4").tobytes() for x, y in zip(ends, ends[1:], strict=False)]
                yield pa.record_batch(
                    [
                        pa.array([file] * n, pa.int32()),
                        pa.array([block - part] * n, pa.int32()),
                        pa.array([part] * n, pa.int32()),
                        pa.array([parts] * n, pa.int32()),
                        pa.array(start + ends[:-1], pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["file", "doc", "part", "parts", "start", "doc_id", "ids"],
                )

    names = [*RAW_NAMES[:7], "checkpoints", "bits"]
    blocks = spark.read.parquet(f"{folder}/blocks").where(which)
    return blocks.select(*names).mapInArrow(decode, PART_FIELDS)


PART_FIELDS = "file int, doc int, part int, parts int, start bigint, doc_id bigint, ids binary"


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document: how many ids come before it in all files, and its own.

    Ids are little-endian unsigned 32-bit integers. Only documents longer than a block are shuffled.
    """
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("file").agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size)).alias("n")
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file, of which there are as many as shuffle partitions.
    offsets = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        ids = b"".join(table["ids"].to_pylist())
        first = table.slice(0, 1).drop_columns(["doc", "part", "parts", "ids"])
        return first.append_column("ids", pa.array([ids], pa.binary()))

    long = read_parts(spark, folder, "parts > 1").groupBy("file", "doc").applyInArrow(
        gather, "file int, start bigint, doc_id bigint, ids binary"
    )
    whole = read_parts(spark, folder, "parts = 1").select("file", "start", "doc_id", "ids").unionByName(long)
    return whole.join(F.broadcast(offsets), "file").select(
        "doc_id", (F.col("offset") + F.col("start")).alias("start"), "ids"
    )


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write token files of ``docs`` to the shared folder and read them back (:func:`read_files`)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    write_files(docs, folder, tokenizer)
    return read_files(spark, folder)
