"""Operator 5: exact deduplication by recipes of content-defined chunks. DataFrame functions only.

A text is cut into chunks at places its content decides: at the first sentence end or line break after
``MIN_CHUNK`` characters, or at ``MAX_CHUNK``. The chunks put together are the text, so two texts are equal
exactly if their ordered chunk lists are. Chunks get short identifiers, and a text's list of identifiers is
its recipe: recipes are what gets grouped and joined, not texts.

Identifiers are verified, not trusted: over the distinct chunks of all texts, no two different ones may
share an identifier. That takes one shuffle of distinct chunks (copies are combined before it), whose keys
are the chunks themselves. If two share one, the next, longer identifier is verified instead, and in the
end the chunk is its own identifier, so the result is exact whatever the hash does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import fresh, id_and_text, written

MIN_CHUNK = 512
MAX_CHUNK = 4096
CHUNKS = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[.!?\n]|.{{1,{MAX_CHUNK}}}"

Digest = Callable[[Column], Column]


def short_digest(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def long_digest(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


DIGESTS: tuple[Digest, ...] = (short_digest, long_digest)


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNKS), F.lit(0))


def verified_digest(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> Digest:
    """The first digest that gives different chunks of ``docs`` different identifiers."""
    pieces = id_and_text(docs).select(F.explode(chunks(F.col("text"))).alias("chunk"))
    for digest in digests:
        distinct = pieces.select(digest(F.col("chunk")).alias("id"), "chunk").distinct()
        worst = distinct.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if worst is None or worst == 1:
            return digest
    return lambda chunk: chunk


def recipe(text: Column, digest: Digest) -> Column:
    return F.transform(chunks(F.coalesce(text, F.lit(""))), digest)


def copy_groups(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Rows with equal texts (null: empty) are a group. The row with the largest doc_id stays; of several rows
    with that doc_id one stays, and in a group without any doc_id one stays with a null keep_id. An empty
    table gives no rows. Other columns are not read.
    """
    digest = verified_digest(docs, digests)
    rows = written(
        id_and_text(docs).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            recipe(F.col("text"), digest).alias("recipe"),
            F.sha2("text", 256).alias("text_sha256"),
        ),
        "recipes",
    )
    groups = (
        rows.groupBy("recipe")
        .agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("keep"))
        .where("size > 1")
    )
    # A left join rather than a window: Spark splits the rows of a large group over tasks.
    return rows.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("keep.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> DataFrame:
    """The rows of ``docs``, all columns, without copies: of equal texts the row with the largest doc_id.

    Of rows equal in text and doc_id the one with the largest other columns (by column name) stays. Whole
    rows move once. Each task passes on one row of a group, so a large group does not reach one task.
    """
    digest = verified_digest(docs, digests)
    key, rank = fresh(docs, "recipe"), fresh(docs, "rank")
    others = sorted(set(docs.columns) - {"doc_id", "text"})
    order = [F.col(f"`{c}`").desc_nulls_last() for c in ["doc_id", *others]]
    ranked = docs.withColumn(key, recipe(F.col("text"), digest)).withColumn(
        rank, F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.where(F.col(rank) == 1).drop(key, rank)
