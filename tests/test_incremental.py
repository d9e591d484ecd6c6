import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from voltlake.operators.incremental import (
    input_gate,
    newer_than,
    newest_by_day,
    newest_ingest,
    on_dates_of,
    rolling_window,
    select_rows,
    stamp_lineage,
    touched_days,
)

SCHEMA = "id int, timestamp timestamp, ingestion_timestamp timestamp"
DAY = "to_date(timestamp)"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def silver(spark):
    return frame(
        spark,
        [(1, at(1, 5), at(2)), (2, at(5), at(6)), (3, at(6, 23), at(7)), (4, at(1, 9), at(9))],
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_watermark_is_strict(spark, silver):
    assert ids(newer_than(silver, silver.where("id = 2"))) == [3, 4]


def test_without_a_watermark_everything_is_new(spark, silver):
    with_null = silver.union(frame(spark, [(5, at(1), None)]))
    nulls = frame(spark, [(1, at(1), None)])
    for target in (None, silver.limit(0), silver.select("id"), nulls):
        assert ids(newer_than(with_null, target)) == [1, 2, 3, 4, 5]
    assert ids(newer_than(with_null, silver.where("id = 3"))) == [4, 5]


def test_watermark_prunes_ingest_partitions(spark, silver, tmp_path):
    path = str(tmp_path / "b")
    silver.withColumn("p", F.to_date("ingestion_timestamp")).write.partitionBy("p").parquet(path)
    out = newer_than(spark.read.parquet(path), silver.where("id = 2"), "p")
    assert ids(out) == [3, 4]
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert re.search(r"p#\d+ >= ", filters) and "ubquery" in filters


def test_lookback_takes_whole_days(spark, silver):
    gold = spark.createDataFrame([(date(2024, 1, 4),), (date(2024, 1, 7),)], "date date")
    assert ids(rolling_window(silver, gold, F.expr(DAY))) == [2, 3]
    assert ids(rolling_window(silver, gold, F.expr(DAY), days=6)) == [1, 2, 3, 4]
    for nothing in (None, gold.limit(0)):
        assert ids(rolling_window(silver, nothing, F.expr(DAY))) == [1, 2, 3, 4]


def test_late_rows_bring_their_whole_day(spark, silver):
    """Row 4 came late for a day far behind the lookback: the day is recomputed from all its rows."""
    then = newest_by_day(silver.where("id < 4"), F.expr(DAY))
    gold = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 5, 6)], "date date")
    assert ids(rolling_window(silver, gold, F.expr(DAY))) == [2, 3]
    assert ids(touched_days(silver, then, F.expr(DAY))) == [1, 4]
    assert ids(touched_days(silver, then.where("_day <> '2024-01-05'"), F.expr(DAY))) == [1, 2, 4]
    assert ids(touched_days(silver, newest_by_day(silver, F.expr(DAY)), F.expr(DAY))) == []
    assert ids(touched_days(silver, None, F.expr(DAY))) == [1, 2, 3, 4]


def test_rows_without_a_day_are_a_day_of_their_own(spark, silver):
    with_null = silver.union(frame(spark, [(5, None, at(9)), (6, None, at(8))]))
    then = newest_by_day(with_null.where("id <> 5"), F.expr(DAY))
    assert ids(touched_days(with_null, then, F.expr(DAY))) == [5, 6]
    assert ids(on_dates_of(with_null, F.expr(DAY), with_null.where("id = 5"), F.expr(DAY))) == [5, 6]
    gold = spark.createDataFrame([(date(2024, 1, 7),)], "date date")
    for nothing in (None, gold.limit(0)):
        assert ids(rolling_window(with_null, nothing, F.expr(DAY))) == [1, 2, 3, 4, 5, 6]


def test_a_day_in_the_future_hides_nothing(spark, silver):
    gold = spark.createDataFrame([(date(2099, 1, 1),), (date(2024, 1, 4),)], "date date")
    today = F.lit(date(2024, 1, 7))
    assert ids(rolling_window(silver, gold, F.expr(DAY), today=today)) == [2, 3]


def test_overlap_and_rows_without_an_ingest_time(spark, silver):
    with_null = silver.union(frame(spark, [(5, at(1), None)]))
    assert ids(newer_than(with_null, silver, overlap_days=0)) == [5]
    assert ids(newer_than(with_null, silver, overlap_days=3)) == [3, 4, 5]


def test_filters_and_transform(spark, silver):
    out = select_rows(silver, ["id > 1", F.col("id") < 4], lambda df: df.withColumn("twice", F.col("id") * 2))
    assert sorted(r.twice for r in out.collect()) == [4, 6]
    assert select_rows(silver).count() == 4


def test_gate_needs_every_input(spark, silver):
    assert input_gate(silver, silver, silver).count() == 4
    assert input_gate(silver, silver, silver.where("id > 9")).count() == 0
    assert input_gate(silver).count() == 4


def test_lineage_is_the_newest_of_all_inputs_and_skips_nulls(spark, silver):
    old, none = silver.where("id = 1"), frame(spark, [(9, at(1), None)])
    assert spark.range(1).select(newest_ingest(old, silver)).first()[0] == at(9)
    assert spark.range(1).select(newest_ingest(none, old)).first()[0] == at(2)
    assert {r.ingestion_timestamp for r in stamp_lineage(old, silver).collect()} == {at(9)}
