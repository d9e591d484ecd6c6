"""Operator 7: token counts by a separator scan of flat, unindexed token files.

A flat file is a run of token ids with an end-of-document id after each document and nothing that tells
where documents start. It is stored as rows of fixed-size blocks that ignore documents.

Each block is searched for end ids in one array operation and summed up by three numbers: how many ends it
has, the tokens before its first end, and those after its last. A prefix scan over these summaries stitches
the boundaries: it gives each block the number of documents ended before it, and the tokens its first
document has in earlier blocks, which reach back to the last block that has an end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.bpe import codec
from voltlake.llm.common import id_and_text, steps, written
from voltlake.llm.token_files import id_type

BLOCK_TOKENS = 1 << 18
BLOCK_SCHEMA = "file int, block int, ids binary, doc_ids array<bigint>, first bigint"


def flat_files(docs: DataFrame, tokenizer: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token files of ``docs``, one for each partition, as blocks of ``block_tokens`` ids.

    Strings of special tokens are encoded as plain text, so ``end_id`` occurs only where a document ends.
    Rows with ``ids`` are the file; rows with ``doc_ids`` (from document number ``first`` on) are a separate
    list of which documents went in, in order, without positions.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        kind = id_type(max(own.size, end_id + 1))
        end = np.array([end_id], dtype=kind)
        file, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        size = 0

        def row(ids: np.ndarray | None, doc_ids: list | None) -> pa.RecordBatch:
            values = [file, block, None if ids is None else ids.tobytes(), doc_ids, first]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
            names = ["file", "block", "ids", "doc_ids", "first"]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in steps(batches):
            doc_ids = batch.column(0).to_pylist()
            yield row(None, doc_ids)
            first += len(doc_ids)
            for text in batch.column(1).to_pylist():
                held += [own.encode(text, special=False).astype(kind), end]
                size += len(held[-2]) + 1
                if size < block_tokens:
                    continue
                ids = np.concatenate(held)
                for k in range(0, size - block_tokens + 1, block_tokens):
                    yield row(ids[k : k + block_tokens], None)
                    block += 1
                held = [ids[len(ids) // block_tokens * block_tokens :]]
                size = len(held[0])
        if any(map(len, held)):
            yield row(np.concatenate(held), None)

    return id_and_text(docs).mapInArrow(encode, BLOCK_SCHEMA)


def document_lengths(blocks: DataFrame, end_id: int, vocabulary: int) -> DataFrame:
    """``file, nth, start, n_tokens`` of every document ended in the blocks (``file, block, ids``).

    ``nth`` counts documents from 0 and ``start`` tokens, both within the file. End ids are not counted.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[k].as_buffer(), id_type(vocabulary))
                ends = np.flatnonzero(ids == end_id)
                values = [
                    batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), len(ids), len(ends),
                    int(ends[-1]) + 1 if len(ends) else 0, ends.astype(np.int32),
                ]
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.record_batch(
                    [pa.array([v], t) for v, t in zip(values, types, strict=True)],
                    ["file", "block", "size", "n", "after_last", "ends"],
                )

    found = written(
        blocks.select("file", "block", "ids").mapInArrow(
            scan, "file int, block int, size bigint, n bigint, after_last bigint, ends array<int>"
        ),
        "separators",
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("size").over(before), F.lit(0))
    # Where the document open at the start of a block began: after the last end in any earlier block.
    scanned = (
        found.withColumn("base", base)
        .withColumn("nth", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("last", F.when(F.col("n") > 0, F.col("base") + F.col("after_last")))
        .withColumn("open", F.coalesce(F.max("last").over(before), F.lit(0)))
    )
    starts = F.concat(
        F.array("open"),
        F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda e: F.col("base") + e + 1),
    )
    return (
        scanned.where("n > 0")
        .select("file", "nth", "base", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))))
        .select(
            "file",
            (F.col("nth") + F.col("pos")).alias("nth"),
            F.col("col.start").alias("start"),
            (F.col("base") + F.col("col.end") - F.col("col.start")).alias("n_tokens"),
        )
    )


def token_counts(docs: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, n_tokens, file, start`` of every row, counted in flat token files made of ``docs``.

    Null and empty texts have 0 tokens. Repeated rows and null doc_ids are documents like others; an empty
    table gives no rows. Other columns are not read.
    """
    own = codec(tokenizer)
    end_id = next(iter(own.special.values()), own.size)
    vocabulary = max(own.size, end_id + 1)
    files = written(flat_files(docs, tokenizer, end_id, block_tokens), "flat-tokens")
    lengths = document_lengths(files.where("ids IS NOT NULL"), end_id, vocabulary)
    names = files.where("doc_ids IS NOT NULL").select(
        "file", "first", F.posexplode("doc_ids").alias("pos", "doc_id")
    )
    names = names.select("file", (F.col("first") + F.col("pos")).alias("nth"), "doc_id")
    return names.join(lengths, ["file", "nth"]).select("doc_id", "n_tokens", "file", "start")
