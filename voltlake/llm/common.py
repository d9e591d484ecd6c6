"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltlake.sources.staging import new_folder

#: Rows handed to Python code at a time inside a task: bounds what one step holds, not what it reads.
STEP_ROWS = 512
STEP_BYTES = 8 << 20
#: Keys that a sample names in its plan; with more of them all rows are ranked.
NAMED_KEYS = 10_000
#: Slices in which the rows of a key are ranked first.
SLICES = 64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; a null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def steps(batches: Iterator[pa.RecordBatch], column: str | int = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most STEP_ROWS rows and, but for single rows, STEP_BYTES of ``column``."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist() if batch.num_rows else []
        start = total = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and (i - start >= STEP_ROWS or total + size > STEP_BYTES):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def item_blocks(items: DataFrame, block_bytes: int, finer: int = 16) -> Iterator[list[tuple[int, str, int]]]:
    """The different ``(item_id, text)`` of a stated set of queries, with their number of rows, in bounded blocks.

    Hash ranges are made narrower until each holds at most ``block_bytes`` of text or one item; blocks are runs of
    them, cut where their sizes, summed by Spark, would exceed ``block_bytes``. One block at a time is on the
    driver. Null texts are left out.
    """
    rows = items.select("item_id", "text").where("text IS NOT NULL")
    total = rows.distinct().agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = finer * max(1, -(-total // block_bytes))
    while True:
        bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
        sums = rows.distinct().groupBy(bucket.alias("k")).agg(F.sum(F.octet_length("text")), F.count("*"))
        sizes = sorted(map(tuple, sums.collect()))
        if all(size <= block_bytes or n == 1 for _, size, n in sizes):
            break
        count *= finer
    cuts, filled = [0], 0
    for k, size, _ in sizes:
        if filled and filled + size > block_bytes:
            cuts.append(k)
            filled = 0
        filled += size
    for lo, hi in zip(cuts, [*cuts[1:], count], strict=True):
        block = rows.where((bucket >= lo) & (bucket < hi)).groupBy("item_id", "text").agg(F.count("*").alias("n"))
        yield sorted(map(tuple, block.collect()), key=repr)


def hash_sample(rows: DataFrame, key: str, size: int, *marks: str) -> DataFrame:
    """At most ``size`` rows of each ``key``: those with the smallest hashes of the columns ``marks``.

    The rows of each key are counted first, and hashes far above those needed are left out by the scan, so what is
    ranked stays near ``size`` rows a key however many there are, and a frequent key is ranked in slices first.
    """
    mark, part, n = fresh(rows, "mark"), fresh(rows, "part"), fresh(rows, "n")
    marked = rows.withColumn(mark, F.xxhash64(*marks))
    counts = rows.groupBy(key).count().limit(NAMED_KEYS + 1).collect()
    if 0 < len(counts) <= NAMED_KEYS:
        # With four times as many expected, fewer than ``size`` below the bound are out of the question.
        bound = {k: min(1.0, max(4 * size, 100) / count) * 2**64 - 2**63 for k, count in counts if k is not None}
        pairs = [F.lit(x) for k, b in bound.items() for x in (k, min(int(b), 2**63 - 1))]
        marked = marked.where(F.col(mark) <= F.create_map(*pairs)[F.col(key)])
    order = [F.col(f"`{c}`") for c in [mark, *marks]]
    marked = marked.withColumn(part, F.pmod(mark, F.lit(SLICES)))
    for by in ([key, part], [key]):
        marked = marked.withColumn(n, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        marked = marked.where(F.col(n) <= size).drop(n)
    return marked.drop(mark, part)


def written(rows: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` written once to the shared folder, in subfolders by the columns ``by``, and read back.

    What reads them several times reads files instead of repeating the work, and values such as
    ``monotonically_increasing_id()`` are settled. The folder lies in ``spark.checkpoint.dir`` and stays
    there, since the result is read lazily.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    rows.write.option("compression", "zstd").partitionBy(*by).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have, compared as Spark does, without case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
