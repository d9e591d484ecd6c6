"""Which rows a run has to look at, and which runs may go ahead.

Watermarks and gates are scalar subqueries inside the plan: no driver round trip, no join, and a
predicate on a partition column still prunes partitions when the query runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.functions import period_of
from voltlake.sources.feeds import LOOKBACK_DAYS

INGESTED = "ingestion_timestamp"


def newer_than(
    rows: DataFrame,
    target: DataFrame | None,
    period: str | None = None,
    grain: str = "day",
    overlap_days: int = 0,
    mark: Column | None = None,
) -> DataFrame:
    """Rows ingested after everything in ``target``, and rows without an ingest time.

    All rows if there is no target, it has no ingest time, or it is empty. With ``mark``, the newest ingest
    time in ``target`` where it is known, the target is not read. ``period`` names the
    partition column of ``rows`` if no row lies in an earlier one than the ``grain`` of its ingest time.
    ``overlap_days`` goes back behind the mark by that much, for landings that end after a newer one was
    merged: merging by newest ingest makes the repeated rows harmless.
    """
    if target is None or INGESTED not in target.columns:
        return rows
    if mark is None:
        mark = target.agg(F.max(F.col(INGESTED).cast("timestamp"))).scalar()
    if overlap_days:
        mark = mark - F.make_dt_interval(days=F.lit(overlap_days))
    if period is not None:
        known = F.col(period)
        rows = rows.where((known >= period_of(mark, grain)) | known.isNull() | mark.isNull())
    return rows.where((F.col(INGESTED) > mark) | F.col(INGESTED).isNull() | mark.isNull())


def rolling_window(
    silver: DataFrame,
    gold: DataFrame | None,
    day: Column | str,
    gold_day: Column | str = "date",
    days: int = LOOKBACK_DAYS,
    period: str | None = None,
    grain: str = "day",
    margin: int = 0,
    today: Column | None = None,
) -> DataFrame:
    """Whole event days from ``days`` before the last day in ``gold``; everything if it has none.

    The last day counts as ``today`` (the current date) at most, so that an observation dated into the
    future does not hide the days before it. ``period`` names the partition column of ``silver`` if that
    is the ``grain`` of the event time, ``margin`` the days by which ``day`` may run ahead of it, as local
    days do.
    """
    if gold is None:
        return silver
    today = F.current_date() if today is None else today
    last = gold.agg(F.max(gold_day)).scalar()
    since = F.date_sub(F.when(last.isNotNull(), F.least(last, today)), days)
    if period is not None:
        first = period_of(F.date_sub(since, margin), grain)
        silver = silver.where((F.col(period) >= first) | since.isNull())
    return silver.where((_column(day) >= since) | since.isNull())


def newest_by_day(silver: DataFrame, day: Column | str) -> DataFrame:
    """``_day`` and ``_newest``: when the newest row of each event day came in."""
    return silver.groupBy(_column(day).alias("_day")).agg(F.max(INGESTED).alias("_newest"))


def changed_days(newest: DataFrame, done: DataFrame) -> DataFrame:
    """Days (``_day``) of ``newest`` that ``done`` lacks or has with an older ``_newest``.

    Both come from :func:`newest_by_day`. Days are held against themselves, feed by feed: neither the
    refresh of other days nor a newer row of another feed hides a row that came in late.
    """
    then = done.select(F.col("_day").alias("_done_day"), F.col("_newest").alias("_done"))
    joined = newest.join(then, F.col("_day").eqNullSafe(F.col("_done_day")), "left")
    return joined.where(F.col("_done").isNull() | (F.col("_newest") > F.col("_done"))).select("_day")


def touched_days(silver: DataFrame, done: DataFrame | None, day: Column | str) -> DataFrame:
    """All rows of the days with late or corrected rows since ``done``, however old the day."""
    if done is None:
        return silver
    return on_dates_of(silver, day, changed_days(newest_by_day(silver, day), done), "_day")


def on_dates_of(
    rows: DataFrame, day: Column | str, other: DataFrame, other_day: Column | str
) -> DataFrame:
    """Rows whose date ``day`` occurs in ``other``; null is a date like any other.

    Dates are compared as text, with nothing for null, because only a plain equality lets Spark prune
    partitions while the query runs. Spark broadcasts the distinct dates if they are few.
    """
    dates = other.select(date_text(_column(other_day)).alias("_on")).distinct()
    return rows.join(dates, date_text(_column(day)) == F.col("_on"), "left_semi")


def date_text(day: Column) -> Column:
    return F.coalesce(day.cast("date").cast("string"), F.lit(""))


def select_rows(
    rows: DataFrame,
    filters: Iterable[Column | str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows meeting every one of ``filters``, passed through ``transform``."""
    kept = reduce(DataFrame.where, filters, rows)
    return kept if transform is None else kept.transform(transform)


def input_gate(rows: DataFrame, *inputs: DataFrame) -> DataFrame:
    """``rows`` if every one of ``inputs`` has a row, else none."""
    return reduce(lambda kept, needed: kept.where(needed.exists()), inputs, rows)


def newest_ingest(*inputs: DataFrame) -> Column:
    """Newest ingest time over the inputs, as a column for the rows derived from them."""
    return _latest([i.agg(F.max(F.col(INGESTED).cast("timestamp"))).scalar() for i in inputs])


def stamp_lineage(rows: DataFrame, *inputs: DataFrame) -> DataFrame:
    """Store on every row how recent the data it was computed from is."""
    return rows.withColumn(INGESTED, newest_ingest(*inputs))


def stamp_from_rollups(rows: DataFrame, rollups: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """As :func:`stamp_lineage` and :func:`input_gate`, from the rollups that ``rows`` are made of.

    ``names`` are the columns of ``rows`` with the stamps of the rollups (the first column of each). The
    largest whole row of a rollup, stamp first, tells both the newest stamp and whether there is a row. It
    needs every column that ``rows`` needs, so Spark plans the same exchange for it and computes the
    rollup, and reads its input, once.
    """
    largest = [r.agg(F.max(F.struct(*[F.col(f"`{c}`") for c in r.columns]))).scalar() for r in rollups]
    stamps = [m.getField(r.columns[0]) for m, r in zip(largest, rollups, strict=True)]
    # A filter without columns would be moved into the rollups and make them differ; hence the stamp.
    lacking = F.greatest(*[m.isNull().cast("long") for m in largest], 0 * F.unix_micros(F.col(names[0])))
    # The stamps of the row itself add nothing but the use of their columns.
    return rows.where(lacking == 0).withColumn(INGESTED, _latest([*stamps, *map(F.col, names)]))


def _latest(marks: list[Column]) -> Column:
    return marks[0] if len(marks) == 1 else F.greatest(*marks)


def _column(day: Column | str) -> Column:
    return F.col(day) if isinstance(day, str) else day
