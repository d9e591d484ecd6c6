"""Operator 2: contiguous shards of near equal bytes, by prefix sums over partition totals.

Rows are put in order of ``doc_id`` over range partitions. Only ids, sizes and checksums are sorted, never
texts. The byte and row totals of the partitions (one row each) get prefix sums; added to the running sums
inside each partition they give every row its place in the whole, and equal targets cut it into shards.
No partition's rows depend on the rows of another, so no task sees more than its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import id_and_text, written

SHARDS = 16
#: Range partitions for each shuffle partition: smaller ones pack evenly into tasks.
FINER = 4


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Size: UTF-8 bytes of the text (null: none) plus 1. A row goes to the shard that holds its middle byte,
    so every shard ends at the row boundary nearest to its target and sizes differ from an equal share by
    at most the two rows at its ends. Shards are contiguous in doc_id order, nulls first; rows with equal
    doc_id stay in scan order. With fewer rows than shards some shards are empty. ``slot`` counts the rows
    of a shard from 0. Equal texts are not kept together: contiguity and balance decide. An empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    slim = id_and_text(docs).select(
        "doc_id",
        (F.octet_length("text") + F.lit(1)).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    # The row number keeps a doc_id with very many rows from being one range.
    slim = written(slim.withColumn("at", F.monotonically_increasing_id()), "shard-sizes")
    ranges = FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        slim.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "at").withColumn(
            "part", F.spark_partition_id()
        ),
        "shard-ranges",
    )

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "at")
    # At most one offset row for each range, so their number is bounded by the setting above.
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "part")
        .withColumn("middle", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
        .withColumn("shard", F.expr(f"cast(middle * {shards} div (2 * all_bytes) as int)"))
        .withColumn("place", F.col("rows_before") + F.col("nth") - 1)
    )
    placed = written(placed.select("doc_id", "size", "text_crc32", "shard", "place"), "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
