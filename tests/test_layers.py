"""Whole refreshes: incremental equals full, late rows, local days, and the streaming form."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.payloads import bronze, bronze_by_content
from checks.views import view
from voltlake.operators.incremental import newer_than
from voltlake.plans.layers import (
    MARTS,
    bronze_path,
    days_path,
    gold_path,
    late_days,
    refresh_gold,
    refresh_layers,
    refresh_silver,
    rejects_path,
    silver_path,
)
from voltlake.plans.silver import observations
from voltlake.sources import feeds
from voltlake.sources.bronze import append_bronze
from voltlake.sources.tables import read_table, unfinished, write_periods
from voltlake.streaming.silver import follow_bronze

SF = "/root/testdata/sf0.001"
DEMAND_MART = MARTS[0]


def demand_payloads(spark):
    return bronze(view(spark, SF, "v_batches"), feeds.STATE_DEMAND)


def table_rows(spark, path, without=("ingestion_timestamp", "processed_timestamp", "_period")):
    df = read_table(spark, path)
    doubles = {n: F.round(n, 6) for n, t in df.dtypes if t == "double"}
    df = df.withColumns(doubles).drop(*without)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def refresh_in_steps(spark, root, cuts, **options):
    rows = demand_payloads(spark)
    low = datetime(1900, 1, 1)
    for high in (*cuts, datetime(2100, 1, 1)):
        part = rows.where(f"ingestion_timestamp > '{low}' AND ingestion_timestamp <= '{high}'")
        append_bronze(part, bronze_path(root, feeds.STATE_DEMAND), feeds.STATE_DEMAND)
        refresh_layers(spark, root, [feeds.STATE_DEMAND], [DEMAND_MART], **options)
        low = high


CUTS = [datetime(2024, 1, 10), datetime(2024, 1, 11), datetime(2024, 1, 20)]


INDIA = {"tz": "Asia/Kolkata"}


@pytest.mark.parametrize("options", [{}, {"late": True}, INDIA, {**INDIA, "late": True}])
def test_refreshing_in_steps_equals_refreshing_once(spark, tmp_path, options):
    steps, once = str(tmp_path / "steps"), str(tmp_path / "once")
    refresh_in_steps(spark, steps, CUTS, **options)
    refresh_in_steps(spark, once, [], **{k: v for k, v in options.items() if k == "tz"})
    for path in (silver_path(steps, feeds.STATE_DEMAND), gold_path(steps, DEMAND_MART)):
        assert table_rows(spark, path) == table_rows(spark, path.replace(steps, once))


def test_refreshing_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    refresh_in_steps(spark, root, [])
    path = gold_path(root, DEMAND_MART)
    before = table_rows(spark, path, without=("_period",))
    assert refresh_silver(spark, root, feeds.STATE_DEMAND, overlap_days=0) is False
    for late in (False, True):
        refresh_silver(spark, root, feeds.STATE_DEMAND)
        refresh_gold(spark, root, DEMAND_MART, late=late)
        assert table_rows(spark, path, without=("_period",)) == before


def test_late_rows_need_the_late_refresh(spark, tmp_path):
    """A correction for the first day arrives last: the lookback does not reach it, ``late`` does."""
    root = str(tmp_path)
    path = bronze_path(root, feeds.STATE_DEMAND)
    rows = demand_payloads(spark)
    append_bronze(rows.where("ingestion_timestamp < '2024-02-01'"), path, feeds.STATE_DEMAND)
    refresh_layers(spark, root, [feeds.STATE_DEMAND], [DEMAND_MART])
    late = view(spark, SF, "v_demand").where("timestamp < '2024-01-02'").withColumns(
        {"demand_mw": F.lit(7777.0), "ingestion_timestamp": F.lit(datetime(2024, 3, 1))}
    )
    append_bronze(bronze(late, feeds.STATE_DEMAND), path, feeds.STATE_DEMAND)
    refresh_silver(spark, root, feeds.STATE_DEMAND)

    def peak():
        gold = read_table(spark, gold_path(root, DEMAND_MART))
        return gold.where("date = '2024-01-01'").agg(F.max("peak_demand_mw")).first()[0]

    refresh_gold(spark, root, DEMAND_MART)
    assert peak() != 7777.0
    refresh_gold(spark, root, DEMAND_MART, late=True)
    assert peak() == 7777.0


def test_a_refresh_of_other_days_does_not_hide_a_late_row(spark, tmp_path):
    """Rolling refreshes move the table's newest ingest time past the late row; its day is still found."""
    root = str(tmp_path)
    path = bronze_path(root, feeds.STATE_DEMAND)
    rows = view(spark, SF, "v_demand")

    def arrive(part, mw, at):
        part = part.withColumns({"demand_mw": F.lit(mw), "ingestion_timestamp": F.lit(at)})
        append_bronze(bronze(part, feeds.STATE_DEMAND), path, feeds.STATE_DEMAND)
        refresh_layers(spark, root, [feeds.STATE_DEMAND], [DEMAND_MART])

    arrive(rows, 1.0, datetime(2024, 2, 1))
    arrive(rows.where("timestamp < '2024-01-02'"), 7777.0, datetime(2024, 3, 1))
    arrive(rows.where("timestamp > '2024-01-29'"), 2.0, datetime(2024, 3, 2))
    gold = read_table(spark, gold_path(root, DEMAND_MART))
    assert gold.agg(F.max("peak_demand_mw")).first()[0] == 2.0
    refresh_gold(spark, root, DEMAND_MART, late=True)
    gold = read_table(spark, gold_path(root, DEMAND_MART))
    assert {r[0] for r in gold.where("peak_demand_mw = 7777").select("date").distinct().collect()} == {
        date(2024, 1, 1)
    }


@pytest.mark.parametrize("noticed", [True, False])
def test_a_merge_that_was_cut_off_is_repaired(spark, tmp_path, noticed):
    """Spark's staging folder gives it away; without one it takes a full refresh."""
    root = str(tmp_path)
    refresh_in_steps(spark, root, [])
    silver, gold = silver_path(root, feeds.STATE_DEMAND), gold_path(root, DEMAND_MART)
    before = table_rows(spark, silver), table_rows(spark, gold)
    lost = read_table(spark, silver).where("state <> 'NATION_3'")
    write_periods(lost, f"{root}/cut_off")
    write_periods(spark.read.parquet(f"{root}/cut_off"), silver)
    assert table_rows(spark, silver) != before[0]
    if noticed:
        for path in (silver, gold):
            (Path(path) / ".spark-staging-0").mkdir()
    refresh_layers(spark, root, [feeds.STATE_DEMAND], [DEMAND_MART], full=not noticed)
    assert (table_rows(spark, silver), table_rows(spark, gold)) == before
    assert not unfinished(spark, silver) and not unfinished(spark, gold)


def arrive(spark, root, rows, feed=feeds.STATE_DEMAND, **options):
    append_bronze(bronze(rows, feed), bronze_path(root, feed), feed)
    refresh_silver(spark, root, feed, **options)


def test_a_landing_that_ended_late_is_read(spark, tmp_path):
    """A landing stamped before the newest merged one: the overlap of a day reads it, none does not."""
    root, rows = str(tmp_path), view(spark, SF, "v_demand")
    stamped = [rows.withColumn("ingestion_timestamp", F.lit(datetime(2024, 2, 3, h))) for h in (6, 5)]
    arrive(spark, root, stamped[0].where("state <> 'NATION_3'"))
    arrive(spark, root, stamped[1].where("state = 'NATION_3'"), overlap_days=0)
    silver = silver_path(root, feeds.STATE_DEMAND)
    missing = rows.where("state = 'NATION_3'").count()
    assert missing and read_table(spark, silver).where("state = 'NATION_3'").isEmpty()
    refresh_silver(spark, root, feeds.STATE_DEMAND)
    assert read_table(spark, silver).where("state = 'NATION_3'").count() == missing


def test_corrected_groups_leave_nothing_behind(spark, tmp_path):
    root, rows = str(tmp_path), view(spark, SF, "v_demand").where("timestamp < '2024-01-04'")
    for region, day in (("North", 5), ("West", 6)):
        stamp = F.lit(datetime(2024, 2, day))
        arrive(spark, root, rows.withColumns({"region": F.lit(region), "ingestion_timestamp": stamp}))
        refresh_gold(spark, root, DEMAND_MART, late=True)
        gold = read_table(spark, gold_path(root, DEMAND_MART))
        assert {r[0] for r in gold.select("region").distinct().collect()} == {region}


def test_days_that_match_nothing_are_not_redone(spark, tmp_path):
    """An hour with weather but no demand gives no Gold row; it is computed once all the same."""
    root, mart = str(tmp_path), MARTS[3]
    arrive(spark, root, view(spark, SF, "v_demand").where("timestamp < '2024-01-05'"))
    arrive(spark, root, view(spark, SF, "v_weather"), feeds.WEATHER)
    refresh_gold(spark, root, mart)
    inputs = [read_table(spark, silver_path(root, feed)) for feed in mart.feeds]
    done = read_table(spark, days_path(root, mart))
    assert done.where("_day > '2024-01-10'").count() > 0
    assert all(rows.isEmpty() for rows in late_days(inputs, done, mart))


def test_rejects_are_kept_once(spark, tmp_path):
    root, rows = str(tmp_path), demand_payloads(spark).where("ingestion_timestamp < '2024-01-05'")
    broken = rows.withColumn("raw_response", F.lit('{"state": "Goa", "poi'))
    append_bronze(rows.union(broken), bronze_path(root, feeds.STATE_DEMAND), feeds.STATE_DEMAND)
    for _ in range(2):
        refresh_silver(spark, root, feeds.STATE_DEMAND, full=True)
        rejects = read_table(spark, rejects_path(root, feeds.STATE_DEMAND))
        assert rejects.count() == broken.select("ingestion_timestamp").distinct().count()
        assert {r.reason for r in rejects.collect()} == {"payload"}


def test_marts_wait_for_their_inputs(spark, tmp_path):
    assert [refresh_gold(spark, str(tmp_path), mart) for mart in MARTS] == [False] * 4


def test_payloads_without_rows_make_no_table(spark, tmp_path):
    root = str(tmp_path)
    rows = demand_payloads(spark).withColumn("raw_response", F.lit('{"state": "Goa", "points": []}'))
    append_bronze(rows, bronze_path(root, feeds.STATE_DEMAND), feeds.STATE_DEMAND)
    assert refresh_silver(spark, root, feeds.STATE_DEMAND) is False
    assert read_table(spark, silver_path(root, feeds.STATE_DEMAND)) is None


def test_processed_time_is_stamped(spark, tmp_path):
    root = str(tmp_path)
    rows = bronze_by_content(view(spark, SF, "v_psp"), feeds.PSP)
    append_bronze(rows, bronze_path(root, feeds.PSP), feeds.PSP)
    started = datetime.now()
    assert refresh_silver(spark, root, feeds.PSP)
    silver = read_table(spark, silver_path(root, feeds.PSP))
    assert silver.drop("_period").columns == feeds.PSP.silver_schema.names
    stamp = silver.agg(F.min("processed_timestamp")).first()[0]
    assert abs(stamp - started) < timedelta(hours=1)


def test_stream_equals_batch(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    rows = demand_payloads(spark)
    feed = replace(feeds.STATE_DEMAND, grain="month")
    for part in ("ingestion_timestamp <= '2024-01-15'", "ingestion_timestamp > '2024-01-15'"):
        append_bronze(rows.where(part), source, feed)
        query = follow_bronze(spark, source, target, feed, checkpoint)
        assert query.awaitTermination(120)
        done = sum(p["numInputRows"] for p in query.recentProgress)
        assert done == rows.where(part).count()
    again = follow_bronze(spark, source, target, feed, checkpoint)
    assert again.awaitTermination(120)
    expected = observations(rows, feed)
    got = read_table(spark, target).select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert newer_than(rows, read_table(spark, target)).isEmpty()
