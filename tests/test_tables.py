import os
import re
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltlake.sources import tables
from voltlake.sources.staging import new_folder, shared_dir, staged
from voltlake.sources.tables import PERIOD, Table, merge_into, read_table

TABLE = Table("t", ("k", "timestamp"), "timestamp")
SCHEMA = "k string, timestamp timestamp, v double, ingestion_timestamp timestamp"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def frame(spark, data):
    return spark.createDataFrame([(*d, at(30)) for d in data], SCHEMA)


def files(path):
    return {str(p): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_first_batch_creates_the_table_and_an_empty_one_does_not(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None
    assert merge_into(frame(spark, []), path, TABLE) is False
    assert read_table(spark, path) is None
    assert merge_into(frame(spark, [("a", at(1), 1.0)]), path, TABLE) is True
    assert rows(read_table(spark, path), "k", "v") == [("a", 1.0)]


def test_only_touched_partitions_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    merge_into(frame(spark, [("a", at(1), 1.0), ("a", at(2), 1.0), ("b", at(2), 1.0)]), path, TABLE)
    before = files(path)
    merge_into(frame(spark, [("a", at(2), 2.0), (None, at(3), 2.0)]), path, TABLE)
    after = files(path)
    untouched = [p for p in before if "2024-01-01" in p]
    assert untouched and all(after[p] == before[p] for p in untouched)
    assert rows(read_table(spark, path), "k", "v") == [("a", 1.0), ("a", 2.0), ("b", 1.0), (None, 2.0)]


def test_merging_twice_and_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [("a", at(1), 1.0), (None, at(1), 2.0)])
    for _ in range(3):
        merge_into(batch, path, TABLE)
    kept = rows(read_table(spark, path), "k", "v")
    assert kept == [("a", 1.0), (None, 2.0)]
    before = files(path)
    assert merge_into(frame(spark, []), path, TABLE) is False
    assert files(path) == before


def test_months_as_partitions(spark, rows, tmp_path):
    path, table = str(tmp_path / "t"), Table("t", TABLE.keys, "timestamp", "month")
    merge_into(frame(spark, [("a", at(1), 1.0), ("a", at(20), 1.0)]), path, table)
    merge_into(frame(spark, [("a", at(20), 2.0)]), path, table)
    out = read_table(spark, path)
    assert rows(out, "v") == [(1.0,), (2.0,)]
    assert {r[0] for r in out.select(PERIOD).distinct().collect()} == {date(2024, 1, 1)}


def stored(spark, path):
    return sorted(((r.k, r.v) for r in read_table(spark, path).select("k", "v").collect()), key=repr)


@pytest.mark.parametrize("named", [tables.NAMED_PERIODS, 0])
def test_merge_prunes_the_partitions_it_reads(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(tables, "NAMED_PERIODS", named)
    path = str(tmp_path / "t")
    merge_into(frame(spark, [("a", at(d), 1.0) for d in range(1, 20)]), path, TABLE)
    batch = frame(spark, [("a", at(2), 2.0)]).withColumn(PERIOD, F.to_date("timestamp"))
    touched = tables.of_periods(read_table(spark, path), batch.select(PERIOD).distinct())
    assert touched.count() == 1
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cast\(_period", plan) or named == 0


@pytest.mark.parametrize("named", [tables.NAMED_PERIODS, 0])
@pytest.mark.parametrize("time", [None, "-0044-03-15 12:00:00", "0000-01-01 00:00:00"])
def test_no_stored_row_of_an_odd_period_is_lost(spark, tmp_path, monkeypatch, named, time):
    monkeypatch.setattr(tables, "NAMED_PERIODS", named)
    path = str(tmp_path / "t")
    when = F.lit(time).cast("timestamp")
    merge_into(frame(spark, [("a", at(1), 1.0)]).withColumn("timestamp", when), path, TABLE)
    merge_into(frame(spark, [("b", at(1), 1.0)]), path, TABLE)
    merge_into(frame(spark, [("c", at(1), 1.0)]).withColumn("timestamp", when), path, TABLE)
    assert stored(spark, path) == [("a", 1.0), ("b", 1.0), ("c", 1.0)]


def test_an_older_batch_does_not_age_a_row(spark, tmp_path):
    newest = replace(TABLE, newest="ingestion_timestamp")
    for table, kept in ((newest, 1.0), (TABLE, 2.0)):
        path = str(tmp_path / f"t{kept}")
        for value, day in ((1.0, 5), (2.0, 3)):
            batch = frame(spark, [("a", at(1), value)]).withColumn("ingestion_timestamp", F.lit(at(day)))
            merge_into(batch, path, table)
        assert stored(spark, path) == [("a", kept)]


def test_replaced_days_keep_only_the_batch(spark, tmp_path):
    path, table = str(tmp_path / "t"), replace(TABLE, grain="month")
    merge_into(frame(spark, [("a", at(1), 1.0), ("b", at(1), 1.0), ("a", at(2), 1.0)]), path, table)
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "d date")
    merge_into(frame(spark, [("c", at(1), 2.0)]), path, table, replaced=days)
    assert stored(spark, path) == [("a", 1.0), ("c", 2.0)]
    assert merge_into(frame(spark, []), path, table, replaced=days) is False
    assert stored(spark, path) == [("a", 1.0), ("c", 2.0)]


def test_only_a_complete_batch_ends_what_was_cut_off(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into(frame(spark, [("a", at(1), 1.0)]), path, TABLE)
    (Path(path) / ".spark-staging-0").mkdir()
    merge_into(frame(spark, [("b", at(1), 1.0)]), path, TABLE)
    assert tables.unfinished(spark, path)
    merge_into(frame(spark, [("b", at(1), 1.0)]), path, TABLE, complete=True)
    assert not tables.unfinished(spark, path)


def test_hot_period_is_written_by_several_tasks(spark, tmp_path):
    """A day far above the advisory size is split instead of going through one task."""
    path, key = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(200000).select(
            F.md5(F.col("id").cast("string")).alias("k"),
            F.lit(at(1)).alias("timestamp"),
            F.col("id").cast("double").alias("v"),
            F.lit(at(1)).alias("ingestion_timestamp"),
        )
        merge_into(rows, path, TABLE)
    finally:
        spark.conf.set(key, old)
    assert len(files(path)) > 1
    assert read_table(spark, path).count() == 200000


def test_staged_rows_are_computed_once_and_removed(spark, rows):
    with staged(frame(spark, [("a", at(1), 1.0)])) as out:
        folder = Path(out.inputFiles()[0].removeprefix("file:")).parent
        assert rows(out, "v") == [(1.0,)] and folder.exists()
    assert not folder.exists()
    with pytest.raises(RuntimeError):
        with staged(frame(spark, [("a", at(1), 1.0)])) as out:
            folder = Path(out.inputFiles()[0].removeprefix("file:")).parent
            raise RuntimeError
    assert not folder.exists()


def test_scratch_folders_lie_in_the_shared_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    before = spark.sparkContext.getCheckpointDir()
    assert configured is None or shared_dir(spark) == configured
    assert spark.sparkContext.getCheckpointDir() == before
    assert new_folder(spark, "x").startswith(shared_dir(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")
