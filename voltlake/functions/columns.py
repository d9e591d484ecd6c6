"""Small column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_day(ts: Column, tz: str | None = None) -> Column:
    """Calendar day of ``ts``, in the session zone or shifted from UTC to ``tz``."""
    return F.to_date(ts if tz is None else F.from_utc_timestamp(ts, tz))


def hour_of(ts: Column, tz: str | None = None) -> Column:
    """Start of the hour of ``ts``."""
    return F.date_trunc("hour", ts if tz is None else F.from_utc_timestamp(ts, tz))


def period_of(ts: Column, grain: str) -> Column:
    """First day of the ``grain`` (``day``, ``month`` and so on) that ``ts`` falls in."""
    return F.to_date(F.date_trunc(grain, ts))


def normalized_key(name: Column) -> Column:
    """Join key that ignores case and surrounding blanks."""
    return F.lower(F.trim(name))


def zero_if_null(measure: Column) -> Column:
    return F.coalesce(measure, F.lit(0.0))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null unless ``whole`` is positive."""
    return F.when(whole > 0, part / whole * 100)


def canonical_json(raw: Column) -> Column:
    """Payload text with sorted object keys and no layout; text that is not JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(raw)), raw)


def content_hash(raw: Column) -> Column:
    """SHA-256 (hex) of the payload content: equal for payloads that differ only in key order."""
    return F.sha2(canonical_json(raw), 256)
