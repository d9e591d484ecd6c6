"""Bronze to Silver as a stream: the checkpoint, not a stored watermark, remembers what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from voltlake.plans.silver import merge_payloads
from voltlake.sources.bronze import FORMAT, reading
from voltlake.sources.feeds import Feed


def follow_bronze(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    feed: Feed,
    checkpoint: str,
    fmt: str = FORMAT,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Merge every Bronze file not merged yet, then stop.

    Merging keeps the newest row of a key, so neither the order of files nor a micro-batch replayed
    after a failure matters. With ``rejects_path``, what cannot be read goes there.
    """
    schema, options = reading(feed, fmt)

    def merge(batch: DataFrame, _: int) -> None:
        merge_payloads(batch, feed, silver_path, rejects_path)

    return (
        spark.readStream.schema(schema)
        .options(**options)
        .format(fmt)
        .load(bronze_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
