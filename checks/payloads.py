"""Bronze rows made from the views: every row becomes one payload in the shape its feed sends.

Payloads are built row by row, so nothing is gathered per state or day. Each list holds the
observation and, after it, the same one with an unreadable time, which conforming has to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.operators.landing import envelope, iso_utc, request_window
from voltlake.sources.feeds import Feed

SOURCE = "grid_api"
UNREADABLE = "n/a"


def record(feed: Feed, time: Column | None = None) -> Column:
    """One observation under its payload field names; ``time`` replaces its time."""
    parts = []
    for f in feed.fields:
        if f.in_record:
            continue
        value = iso_utc(F.col(f.name)) if f.kind == "instant" else F.col(f.name)
        if time is not None and f.name == feed.time:
            value = time
        parts.append(value.cast("string").alias(f.source) if f.kind == "day" else value.alias(f.source))
    return F.struct(*parts)


def observations(feed: Feed) -> Column:
    return F.array(record(feed), record(feed, F.lit(UNREADABLE)))


def payload(feed: Feed, shape: str) -> Column:
    """Payload text of a row, for ``points``, ``items``, ``data``, ``array`` or ``object``."""
    if shape == "array":
        return F.to_json(observations(feed))
    if shape == "object":
        return F.to_json(record(feed))
    outer = [F.col(name) for name in feed.outer_fields]
    return F.to_json(F.struct(*outer, observations(feed).alias(shape)))


def bronze(
    rows: DataFrame,
    feed: Feed,
    shape: str | None = None,
    text: Column | None = None,
    window: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Windowed Bronze rows, asked for at their ingest time unless a ``window`` is given."""
    text = payload(feed, shape or feed.nested or feed.shape) if text is None else text
    return envelope(
        rows.withColumn("raw_response", text),
        feed,
        SOURCE,
        window=request_window(F.col("ingestion_timestamp")) if window is None else window,
        ingested=F.col("ingestion_timestamp"),
    )


def bronze_by_content(rows: DataFrame, feed: Feed) -> DataFrame:
    """Bronze rows identified by content hash."""
    return envelope(
        rows.withColumn("raw_response", payload(feed, feed.shape)),
        feed,
        SOURCE,
        ingested=F.col("ingestion_timestamp"),
    )
