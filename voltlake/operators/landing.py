"""Wrapping payloads for Bronze and landing each of them once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.functions import content_hash
from voltlake.operators.dedupe import one_per_key
from voltlake.sources.feeds import REQUEST_HOURS, Feed

WINDOW_KEY = ["source", "dataset", "from_timestamp", "to_timestamp"]
ENTITY_KEY = [*WINDOW_KEY, "state"]
HASH_KEY = ["source", "dataset", "response_hash"]
KEY_MARK = "_key_mark"


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of a UTC time, with microseconds and ``Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def request_window(at: Column, hours: int = REQUEST_HOURS) -> tuple[Column, Column]:
    """(from, to) of the request made ``at`` a time: the ``hours`` before it, as ISO text."""
    return iso_utc(at - F.make_dt_interval(hours=F.lit(hours))), iso_utc(at)


def envelope(
    payloads: DataFrame,
    feed: Feed,
    source: str,
    *,
    raw: str = "raw_response",
    window: tuple[Column, Column] | None = None,
    hours: int = REQUEST_HOURS,
    ingested: Column | None = None,
) -> DataFrame:
    """Bronze rows for a DataFrame of payload texts.

    A ``window`` makes windowed rows (with ``state`` for per-state feeds); without one the row is
    identified by its content hash.
    """
    stamp = F.current_timestamp() if ingested is None else ingested.cast("timestamp")
    head = [F.lit(source).alias("source"), F.lit(feed.dataset).alias("dataset")]
    tail = [stamp.alias("ingestion_timestamp"), F.col(raw).alias("raw_response")]
    if window is None:
        return payloads.select(*head, content_hash(F.col(raw)).alias("response_hash"), *tail)
    state = [F.col("state")] if feed.per_state else []
    begin, end = window
    request = [
        begin.alias("from_timestamp"),
        end.alias("to_timestamp"),
        F.lit(hours).cast("bigint").alias("hours"),
    ]
    return payloads.select(*head, *state, *request, *tail)


def land_new(new: DataFrame, landed: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key has not landed, one per key: the earliest, as if landed in turn.

    Keys begin alike (source, dataset, year), so sorts would compare them in full; a hash in front of them tells
    nearly all apart by its first word.
    """
    marked = [KEY_MARK, *keys]
    first = one_per_key(new.withColumn(KEY_MARK, F.xxhash64(*keys)), marked, newest=False)
    if landed is not None:
        known = landed.select(F.xxhash64(*keys).alias(KEY_MARK), *keys).distinct()
        first = first.join(known, marked, "left_anti")
    return first.select(*new.columns)


def landed_keys(landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return landed.select(*keys).distinct()


def landed_entities(
    landed: DataFrame, source: str, dataset: str, begin: str, end: str, entity: str = "state"
) -> DataFrame:
    """Entities that already have a payload for this request window."""
    return (
        landed.where(
            (F.col("source") == source)
            & (F.col("dataset") == dataset)
            & (F.col("from_timestamp") == begin)
            & (F.col("to_timestamp") == end)
        )
        .select(entity)
        .distinct()
    )


def missing_entities(expected: DataFrame, landed: DataFrame, entity: str = "state") -> DataFrame:
    """Entities still to fetch: ``expected`` without the ``landed`` ones."""
    return expected.join(landed, entity, "left_anti")
