import json
from datetime import datetime
from functools import reduce

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.functions import content_hash
from voltlake.operators.landing import (
    ENTITY_KEY,
    HASH_KEY,
    WINDOW_KEY,
    envelope,
    land_new,
    landed_entities,
    missing_entities,
    request_window,
)
from voltlake.session import OPEN_FILES, unsorted_writes
from voltlake.sources.bronze import append_bronze, bronze_schema, could_hold, land, landing_key, scan_bronze
from voltlake.sources.feeds import FEEDS, FREQUENCY, PSP, STATE_DEMAND, STATES, WEATHER

NOW = datetime(2024, 1, 3, 4, 5, 6, 123456)


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_response string")


def windowed(spark, feed, at=NOW, states=("Goa",)):
    rows = spark.createDataFrame([(s, "[]") for s in states], "state string, raw_response string")
    return envelope(rows, feed, "api", window=request_window(F.lit(at)), ingested=F.lit(at))


def test_envelope_of_a_window(spark):
    row = windowed(spark, STATE_DEMAND).first()
    assert row.asDict() == {
        "source": "api",
        "dataset": "state_demand_timeseries",
        "state": "Goa",
        "from_timestamp": "2024-01-01T04:05:06.123456Z",
        "to_timestamp": "2024-01-03T04:05:06.123456Z",
        "hours": 48,
        "ingestion_timestamp": NOW,
        "raw_response": "[]",
    }


@pytest.mark.parametrize("feed", FEEDS.values(), ids=FEEDS.keys())
def test_envelope_has_the_bronze_schema(spark, feed):
    rows = envelope(payloads(spark, "{}"), feed, "api") if feed is PSP else windowed(spark, feed)
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in bronze_schema(feed)
    ]


def test_hash_ignores_key_order_and_layout_only(spark):
    texts = ['{"a": 1, "b": [1, 2]}', '{ "b":[1,2],"a":1 }', '{"a": 1, "b": [2, 1]}', "not json"]
    hashes = [r[0] for r in payloads(spark, *texts).select(content_hash(F.col("raw_response"))).collect()]
    assert hashes[0] == hashes[1]
    assert len(set(hashes)) == 3 and all(len(h) == 64 for h in hashes)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_landing_again_adds_nothing(spark, tmp_path, fmt):
    path = str(tmp_path / "bronze")
    assert scan_bronze(spark, path, WEATHER, fmt).isEmpty()
    land(spark, windowed(spark, WEATHER, states=("Goa", "Delhi")), path, WEATHER, fmt)
    land(spark, windowed(spark, WEATHER, states=("Goa", "Delhi", "Sikkim")), path, WEATHER, fmt)
    rows = scan_bronze(spark, path, WEATHER, fmt)
    assert sorted(r.state for r in rows.collect()) == ["Delhi", "Goa", "Sikkim"]
    assert rows.first().ingestion_timestamp == NOW
    assert rows.first().raw_response == "[]"


def test_window_content_and_entity_keys(spark):
    assert landing_key(FREQUENCY) == WINDOW_KEY
    assert landing_key(STATE_DEMAND) == ENTITY_KEY
    assert landing_key(PSP) == HASH_KEY
    landed = windowed(spark, FREQUENCY)
    later = windowed(spark, FREQUENCY, datetime(2024, 1, 4))
    assert land_new(landed.union(later), landed, WINDOW_KEY).count() == 1


def test_copies_within_a_batch_land_once_the_earliest(spark):
    times = [datetime(2024, 1, d) for d in (3, 2, 4)]
    rows = spark.createDataFrame(
        [(json.dumps({"a": 1}), t) for t in times], "raw_response string, at timestamp"
    )
    out = land_new(envelope(rows, PSP, "api", ingested=F.col("at")), None, HASH_KEY)
    assert [r.ingestion_timestamp for r in out.collect()] == [datetime(2024, 1, 2)]


def test_missing_path_is_empty_but_a_bad_one_is_an_error(spark, tmp_path):
    assert scan_bronze(spark, str(tmp_path / "none"), PSP).columns == bronze_schema(PSP).names
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part.parquet").write_text("this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        scan_bronze(spark, str(bad), PSP, "parquet").collect()
    with pytest.raises(AnalysisException):
        scan_bronze(spark, str(tmp_path / "none2"), PSP, "json").select("nothing")


def test_ingest_times_keep_their_microseconds_and_type(spark, tmp_path):
    path = str(tmp_path / "bronze")
    append_bronze(windowed(spark, FREQUENCY), path, FREQUENCY)
    out = scan_bronze(spark, path, FREQUENCY)
    assert out.first().ingestion_timestamp == NOW
    assert dict(out.dtypes)["ingestion_timestamp"] == "timestamp"


def test_bronze_landed_without_partitions_stays_readable(spark, tmp_path):
    path, later = str(tmp_path / "bronze"), datetime(2024, 1, 9)
    old = windowed(spark, FREQUENCY).withColumn(
        "ingestion_timestamp", F.lit("2024-01-03T04:05:06.123Z")
    )
    old.write.mode("append").json(path)
    land(spark, windowed(spark, FREQUENCY), path, FREQUENCY, "json")
    land(spark, windowed(spark, FREQUENCY, later), path, FREQUENCY, "json")
    out = scan_bronze(spark, path, FREQUENCY, "json")
    assert sorted(r.ingestion_timestamp for r in out.collect()) == [
        datetime(2024, 1, 3, 4, 5, 6, 123000),
        later,
    ]


def test_worklist(spark, rows):
    landed = windowed(spark, WEATHER, states=("Goa", "Goa", "Delhi"))
    window = ("2024-01-01T04:05:06.123456Z", "2024-01-03T04:05:06.123456Z")
    have = landed_entities(landed, "api", "weather", *window)
    assert rows(have) == [("Delhi",), ("Goa",)]
    expected = spark.createDataFrame([(s,) for s in STATES], "state string")
    assert len(STATES) == 36
    assert missing_entities(expected, have).count() == 34
    assert landed_entities(landed, "api", "weather", "x", "y").isEmpty()


def test_landing_reads_keys_of_the_periods_it_must(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for day in (1, 9, 20):
        land(spark, windowed(spark, WEATHER, datetime(2024, 1, day)), path, WEATHER)
    new = windowed(spark, WEATHER, datetime(2024, 1, 9), ("Goa", "Delhi"))
    landed = could_hold(scan_bronze(spark, path, WEATHER), new, WEATHER)
    out = land_new(new, landed, landing_key(WEATHER))
    assert [r.state for r in out.collect()] == ["Delhi"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "raw_response" not in scan and "ingest_period" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0].day for r in landed.select("ingest_period").distinct().collect()} == {9, 20}


def test_windows_that_cannot_be_read_rule_out_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    odd = windowed(spark, WEATHER).withColumn("to_timestamp", F.lit("soon"))
    for _ in range(2):
        land(spark, odd.unionByName(windowed(spark, WEATHER, datetime(2024, 5, 1))), path, WEATHER)
    assert scan_bronze(spark, path, WEATHER).count() == 2


def test_files_do_not_grow_with_tasks(spark, tmp_path):
    path = str(tmp_path / "bronze")
    states = [f"s{k}" for k in range(200)]
    append_bronze(windowed(spark, WEATHER, states=states).repartition(40), path, WEATHER)
    assert len(list((tmp_path / "bronze").rglob("*.parquet"))) == 1


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_payloads_are_written_without_a_sort(spark, tmp_path, fmt):
    """A sort by period would hold all rows of a task, however well they compress."""
    path, days = str(tmp_path / "bronze"), [datetime(2024, month, 1) for month in range(1, 13)]
    rows = reduce(DataFrame.unionByName, [windowed(spark, FREQUENCY, day) for day in days])
    store = spark._jsparkSession.sharedState().statusStore()
    append_bronze(rows, path, FREQUENCY, fmt)
    plan = store.executionsList().last().physicalPlanDescription()
    assert "WriteFiles" in plan and "Sort" not in plan
    assert sorted(r.ingestion_timestamp for r in scan_bronze(spark, path, FREQUENCY, fmt).collect()) == days


def test_rows_of_more_partitions_than_files_open_are_written(spark, tmp_path):
    path, n = str(tmp_path / "rows"), 2 * OPEN_FILES + 1
    rows = spark.range(0, 3 * n, numPartitions=1).withColumn("part", F.col("id") % n)
    with unsorted_writes(spark):
        rows.write.partitionBy("part").parquet(path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(k, k % n) for k in range(3 * n)}


def test_landing_sorts_by_a_hash_of_the_key_first(spark, tmp_path, rows):
    """Window ends of one day share their first words, by which a sort tells rows apart."""
    new = windowed(spark, WEATHER, states=("Goa", "Goa", None, None, "Delhi"))
    landed = windowed(spark, WEATHER, states=("Delhi", None))
    out = land_new(new, landed, ENTITY_KEY)
    assert out.columns == new.columns
    assert rows(out, "state") == [("Goa",), (None,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [_key_mark" in line for line in sorts)
    assert plan.count("Exchange hashpartitioning(_key_mark") >= 1
