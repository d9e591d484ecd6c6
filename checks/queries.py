"""The registered queries: library operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.payloads import SOURCE, bronze, bronze_by_content, payload
from checks.views import load, view
from voltlake.functions import normalized_key
from voltlake.operators import derived, incremental, landing, rollups
from voltlake.operators.conform import conform, stamp_processed
from voltlake.operators.dedupe import one_per_key
from voltlake.operators.flatten import flatten, flatten_inferred, payload_fields, rejected
from voltlake.operators.incremental import newer_than, rolling_window
from voltlake.operators.landing import iso_utc, request_window
from voltlake.operators.upsert import upsert
from voltlake.plans import marts
from voltlake.plans.layers import (
    MARTS,
    bronze_path,
    gold_path,
    refresh_gold,
    refresh_layers,
    silver_path,
    together,
)
from voltlake.plans.silver import observations, silver_batch
from voltlake.session import pin_utc, unsorted_writes
from voltlake.sources import feeds
from voltlake.sources.bronze import append_bronze, land, scan_bronze
from voltlake.sources.staging import new_folder
from voltlake.sources.tables import PERIOD, Table, merge_into, read_table, silver_table
from voltlake.streaming.silver import follow_bronze

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
OBSERVATIONS = Table("observations", ("state", "timestamp", "source"), "timestamp")
OBSERVED = ["state", "timestamp", "source", "demand_mw", "ingestion_timestamp"]
# Where the history ends that earlier runs have dealt with, in events and in orders.
HISTORY = datetime(2024, 1, 20)
OVERLAP = datetime(2024, 1, 16)
ORDER_HISTORY = datetime(1998, 1, 1)
def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(pin_utc(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def event_day():
    return F.to_date("timestamp")


def present(rows: DataFrame) -> DataFrame:
    """Doubles rounded and times zone-free, as the SQL side has them.

    Averages differ in their last bits with the order of summing. They are rounded to multiples of
    2^-16, where, unlike in decimal places, an average of two-decimal values is never half way.
    """

    def column(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return (F.round(F.col(f.name) * 65536.0) / 65536.0).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return rows.select(*[column(f) for f in rows.schema])


# Landing


@query
def bronze_scan(spark, sf_dir):
    path = new_folder(spark, "bronze")
    rows = bronze(view(spark, sf_dir, "v_demand"), feeds.STATE_DEMAND)
    append_bronze(rows, path, feeds.STATE_DEMAND, "json")
    rows = scan_bronze(spark, path, feeds.STATE_DEMAND, "json").drop("corrupt_line")
    raw = F.col("raw_response")
    return rows.select(
        *[c for c in rows.columns if c not in ("raw_response", "ingest_period")],
        F.get_json_object(raw, "$.points[0].timestamp").alias("first_timestamp"),
        F.get_json_object(raw, "$.points[0].demand_mw").cast("double").alias("first_demand_mw"),
        F.get_json_object(raw, "$.points[1].timestamp").alias("second_timestamp"),
    )


@query
def envelope_build(spark, sf_dir):
    rows = bronze(view(spark, sf_dir, "v_weather"), feeds.WEATHER)
    points = F.get_json_object("raw_response", "$.points")
    return rows.select(
        *[c for c in rows.columns if c != "raw_response"],
        F.json_array_length(points).cast("bigint").alias("n_points"),
        F.get_json_object("raw_response", "$.points[0].ts_utc").alias("first_ts_utc"),
    )


def landed_twice(spark, feed, landed, new):
    """Bronze after both have landed, one after the other."""
    path = new_folder(spark, "bronze")
    for rows in (landed, new):
        land(spark, rows, path, feed)
    return scan_bronze(spark, path, feed)


@query
def land_window_dedup(spark, sf_dir):
    new = bronze(view(spark, sf_dir, "v_national_demand"), feeds.NATIONAL_DEMAND)
    landed = new.where(F.col("ingestion_timestamp") < F.lit(ORDER_HISTORY))
    return landed_twice(spark, feeds.NATIONAL_DEMAND, landed, new).drop("raw_response", "ingest_period")


@query
def land_entity_dedup(spark, sf_dir):
    new = hourly_requests(spark, sf_dir)
    landed = new.where(
        (F.col("ingestion_timestamp") < F.lit(OVERLAP)) | F.col("region").isin("ASIA", "EUROPE")
    )
    rows = landed_twice(spark, feeds.STATE_DEMAND, landed.drop("region"), new.drop("region"))
    return rows.select(*landing.ENTITY_KEY)


@query
def land_hash_dedup(spark, sf_dir):
    def rows(text):
        events = load(spark, sf_dir, "events").withColumn("amount", F.floor("value"))
        return landing.envelope(
            events.withColumn("raw_response", text), feeds.PSP, SOURCE, ingested=F.col("ts")
        )

    new = rows(F.to_json(F.struct("user_id", "amount")))
    landed = rows(F.format_string('{ "amount": %d,  "user_id": %d }', "amount", "user_id")).where(
        F.col("ingestion_timestamp") < F.lit(OVERLAP)
    )
    return landed_twice(spark, feeds.PSP, landed, new).select(
        "source",
        "dataset",
        "ingestion_timestamp",
        *[F.get_json_object("raw_response", f"$.{c}").cast("bigint").alias(c) for c in ("user_id", "amount")],
    )


def hourly_requests(spark, sf_dir):
    """State demand payloads asked for by the hour; ``region`` tells what landed."""
    rows = view(spark, sf_dir, "v_demand")
    end = F.date_trunc("hour", "timestamp") + F.expr("INTERVAL '1' HOUR")
    return rows.select(
        F.lit(SOURCE).alias("source"),
        F.lit(feeds.STATE_DEMAND.dataset).alias("dataset"),
        "state",
        *[c.alias(n) for c, n in zip(landing.request_window(end, 1), ("from_timestamp", "to_timestamp"))],
        F.lit(1).cast("bigint").alias("hours"),
        end.alias("ingestion_timestamp"),
        F.lit("{}").alias("raw_response"),
        "region",
    )


@query
def landed_entities(spark, sf_dir):
    return landing.landed_entities(
        hourly_requests(spark, sf_dir),
        SOURCE,
        feeds.STATE_DEMAND.dataset,
        "2024-01-05T10:00:00.000000Z",
        "2024-01-05T11:00:00.000000Z",
    )


@query
def missing_entities(spark, sf_dir):
    expected = load(spark, sf_dir, "nation").select(F.col("n_name").alias("state"))
    return landing.missing_entities(expected, landed_entities(spark, sf_dir))


# Parsing


@query
def infer_payload_schema(spark, sf_dir):
    rows = bronze_by_content(view(spark, sf_dir, "v_psp"), feeds.PSP)
    kind = (
        F.when(F.col("type") == "STRING", "text")
        .when(F.col("type") == "BOOLEAN", "flag")
        .when(F.col("type").rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"), "whole")
        .when(F.col("type").rlike(r"^(DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)$"), "fraction")
        .otherwise(F.col("type"))
    )
    return payload_fields(rows, "items").select("field", kind.alias("kind"))


@query
def shape_errors(spark, sf_dir):
    """What is said about payloads without a column or of an unknown shape, next to the rows it concerns."""
    rows = view(spark, sf_dir, "v_frequency")
    broken = {
        "table": (bronze(rows, feeds.FREQUENCY, "array"), replace(feeds.FREQUENCY, shape="table")),
        "none": (rows, feeds.FREQUENCY),
    }
    found = []
    for name, (payloads, feed) in broken.items():
        try:
            flatten(payloads, feed)
            message = None
        except ValueError as error:
            message = str(error)
        counts = payloads.agg(F.count(F.lit(1)).alias("n_rows"))
        found.append(counts.select(F.lit(name).alias("shape"), F.lit(message).alias("message"), "n_rows"))
    return reduce(DataFrame.unionByName, found)


def frequency_records(spark, sf_dir, shape):
    rows = bronze(view(spark, sf_dir, "v_frequency"), feeds.FREQUENCY, shape)
    return flatten(rows, feeds.FREQUENCY).select(
        "dataset",
        "ingestion_timestamp",
        "timestamp",
        F.col("frequency_hz").cast("double").alias("frequency_hz"),
        "region",
    )


@query
def flatten_array(spark, sf_dir):
    return frequency_records(spark, sf_dir, "array")


@query
def flatten_data(spark, sf_dir):
    return frequency_records(spark, sf_dir, "data")


@query
def flatten_object(spark, sf_dir):
    return frequency_records(spark, sf_dir, "object")


@query
def flatten_items(spark, sf_dir):
    records = flatten(bronze_by_content(view(spark, sf_dir, "v_psp"), feeds.PSP), feeds.PSP)
    return records.select(
        "dataset",
        "ingestion_timestamp",
        "date",
        "region",
        "state",
        *[F.col(c).cast("double").alias(c) for c in rollups.ADEQUACY_MEASURES],
        "source_url",
    )


@query
def flatten_points(spark, sf_dir):
    records = flatten(bronze(view(spark, sf_dir, "v_demand"), feeds.STATE_DEMAND), feeds.STATE_DEMAND)
    return records.select(
        "state", "timestamp", "region", F.col("demand_mw").cast("double").alias("demand_mw"), "source_type"
    )


@query
def flatten_outer_nulls(spark, sf_dir):
    """Payloads of the unnamed region have an empty list, those of the South no list at all."""
    region = F.col("region")
    text = (
        F.when(region.isNull(), '{"data": []}')
        .when(region == "South", '{"data": null}')
        .otherwise(payload(feeds.FREQUENCY, "data"))
    )
    rows = bronze(view(spark, sf_dir, "v_frequency"), feeds.FREQUENCY, text=text)
    return flatten(rows, feeds.FREQUENCY).select("ingestion_timestamp", "timestamp", "region")


@query
def flatten_undeclared(spark, sf_dir):
    """The same payloads as ``flatten_data``, with the type found in them instead of a declared one."""
    rows = bronze(view(spark, sf_dir, "v_frequency"), feeds.FREQUENCY, "data")
    return flatten_inferred(rows).select(
        "dataset",
        "ingestion_timestamp",
        "timestamp",
        F.col("frequency_hz").cast("double").alias("frequency_hz"),
        "region",
    )


@query
def unreadable_payloads(spark, sf_dir):
    """The payloads of the unnamed region break off."""
    text = F.when(F.col("region").isNull(), '{"data": [').otherwise(payload(feeds.FREQUENCY, "data"))
    rows = bronze(view(spark, sf_dir, "v_frequency"), feeds.FREQUENCY, text=text)
    return rejected(rows, feeds.FREQUENCY).select("dataset", "ingestion_timestamp", "raw_response")


@query
def rejected_payloads(spark, sf_dir):
    """The payloads of the unnamed region break off, and those of the South arrive as broken lines."""
    path, feed, region = new_folder(spark, "bronze"), feeds.FREQUENCY, F.col("region")
    rows = view(spark, sf_dir, "v_frequency")
    text = F.when(region.isNull(), '{"data": [').otherwise(payload(feed, "data"))
    good = rows.where(region.isNull() | (region != "South"))
    append_bronze(bronze(good, feed, text=text), path, feed, "json")
    lines = rows.where(region == "South").select(
        F.lit('{"source": "grid_api", "dat').alias("value"),
        F.to_date(F.date_trunc("month", "ingestion_timestamp")).alias("ingest_period"),
    )
    with unsorted_writes(spark):
        lines.write.mode("append").partitionBy("ingest_period").text(path)
    return rejected(scan_bronze(spark, path, feed, "json"), feed)


@query
def flatten_metadata(spark, sf_dir):
    records = flatten(bronze(view(spark, sf_dir, "v_demand"), feeds.STATE_DEMAND), feeds.STATE_DEMAND)
    return records.select(
        "bronze_source",
        "dataset",
        "from_timestamp",
        "to_timestamp",
        "hours",
        "ingestion_timestamp",
        "source",
        "timestamp",
    )


# Conforming


def conformed(spark, sf_dir, name, feed):
    return conform(flatten(bronze(view(spark, sf_dir, name), feed), feed), feed)


@query
def conform_state_demand(spark, sf_dir):
    return conformed(spark, sf_dir, "v_demand", feeds.STATE_DEMAND)


@query
def conform_national_demand(spark, sf_dir):
    return conformed(spark, sf_dir, "v_national_demand", feeds.NATIONAL_DEMAND)


@query
def conform_fuelmix(spark, sf_dir):
    return conformed(spark, sf_dir, "v_fuelmix", feeds.FUEL_MIX)


@query
def conform_frequency(spark, sf_dir):
    rows = bronze(view(spark, sf_dir, "v_frequency"), feeds.FREQUENCY, "array")
    return conform(flatten(rows, feeds.FREQUENCY), feeds.FREQUENCY)


@query
def conform_weather(spark, sf_dir):
    return conformed(spark, sf_dir, "v_weather", feeds.WEATHER)


@query
def conform_psp(spark, sf_dir):
    return conform(flatten(bronze_by_content(view(spark, sf_dir, "v_psp"), feeds.PSP), feeds.PSP), feeds.PSP)


@query
def processed_stamp(spark, sf_dir):
    """Whether the stamp lies within the run, for every observation."""
    started = F.lit(datetime.now(timezone.utc))
    rows = stamp_processed(conformed(spark, sf_dir, "v_demand", feeds.STATE_DEMAND))
    inside = F.col("processed_timestamp").between(
        started - F.expr("INTERVAL '1' MINUTE"), started + F.expr("INTERVAL '1' HOUR")
    )
    return rows.select("state", "timestamp", "source", inside.alias("stamped_in_run"))


# Dedupe and upsert


@query
def dedupe_latest(spark, sf_dir):
    return one_per_key(view(spark, sf_dir, "v_fuelmix"), feeds.FUEL_MIX.keys)


def two_batches(spark, sf_dir):
    """What is stored of the first batch, and the overlapping, corrected second one."""
    rows = view(spark, sf_dir, "v_batches")
    stored = rows.where((F.col("batch") == 0) & (F.col("timestamp") < F.lit(HISTORY)))
    batch = rows.where((F.col("batch") == 1) & (F.col("timestamp") >= F.lit(OVERLAP)))
    return stored.select(*OBSERVED), batch.select(*OBSERVED)


@query
def upsert_bootstrap(spark, sf_dir):
    path = new_folder(spark, "table")
    merge_into(view(spark, sf_dir, "v_batches").where("batch = 0"), path, OBSERVATIONS)
    return read_table(spark, path).select(*OBSERVED)


@query
def upsert_empty_batch(spark, sf_dir):
    """A batch without rows leaves the table as it is."""
    path, rows = new_folder(spark, "table"), view(spark, sf_dir, "v_batches")
    for batch in (rows.where("batch = 0"), rows.where("batch = 2")):
        merge_into(batch, path, OBSERVATIONS)
    return read_table(spark, path).select(*OBSERVED)


@query
def upsert_out_of_order(spark, sf_dir):
    """The corrected batch is merged first, the older one after it: the newest ingest time still wins."""
    path, rows = new_folder(spark, "table"), view(spark, sf_dir, "v_batches")
    for batch in (1, 0):
        merge_into(rows.where(F.col("batch") == batch), path, replace(OBSERVATIONS, newest=incremental.INGESTED))
    return read_table(spark, path).select(*OBSERVED)


@query
def upsert_wider_batch(spark, sf_dir):
    """Only the second batch names the region: rows of the first read null there."""
    path, rows = new_folder(spark, "table"), view(spark, sf_dir, "v_batches")
    table = replace(OBSERVATIONS, newest=incremental.INGESTED)
    merge_into(rows.where("batch = 0").select(*OBSERVED), path, table)
    merge_into(rows.where("batch = 1").select(*OBSERVED, "region"), path, table)
    return read_table(spark, path).select(*OBSERVED, "region")


@query
def upsert_merge(spark, sf_dir):
    path = new_folder(spark, "table")
    for batch in two_batches(spark, sf_dir):
        merge_into(batch, path, OBSERVATIONS)
    return read_table(spark, path).select(*OBSERVED)


@query
def upsert_null_safe(spark, sf_dir):
    return upsert(*two_batches(spark, sf_dir), OBSERVATIONS.keys)


@query
def upsert_plain_keys(spark, sf_dir):
    return upsert(*two_batches(spark, sf_dir), OBSERVATIONS.keys, null_safe=False)


# Incremental processing


def gold_so_far(spark, sf_dir):
    return marts.state_demand_mart(
        view(spark, sf_dir, "v_demand").where(F.col("timestamp") < F.lit(HISTORY))
    )


@query
def incremental_watermark(spark, sf_dir):
    rows = view(spark, sf_dir, "v_batches")
    silver = rows.where(F.col("timestamp") < F.lit(HISTORY)).where("batch = 0")
    return newer_than(rows, silver).select(*OBSERVED)


@query
def incremental_filtered(spark, sf_dir):
    recent = rolling_window(view(spark, sf_dir, "v_demand"), gold_so_far(spark, sf_dir), event_day())
    return incremental.select_rows(
        recent,
        [F.col("source_type") == rollups.OFFICIAL, "demand_mw > 10"],
        lambda rows: rows.withColumn("state_key", normalized_key(F.col("state"))),
    ).select("state_key", "timestamp", "demand_mw", "source_type")


@query
def rolling_rebuild(spark, sf_dir):
    """Gold holds the days up to one, Silver also those after it; the refresh reads the partitions of the lookback."""
    root, mart = new_folder(spark, "layers"), MARTS[0]
    table = silver_table(feeds.STATE_DEMAND)
    merge_into(view(spark, sf_dir, "v_demand"), silver_path(root, feeds.STATE_DEMAND), table)
    merge_into(gold_so_far(spark, sf_dir), gold_path(root, mart), mart.table)
    refresh_gold(spark, root, mart)
    return read_table(spark, gold_path(root, mart)).drop(PERIOD)


@query
def touched_dates_rebuild(spark, sf_dir):
    rows = view(spark, sf_dir, "v_batches")
    then = rows.where(F.col("ingestion_timestamp") < F.lit(OVERLAP))
    late = incremental.touched_days(rows, incremental.newest_by_day(then, event_day()), event_day())
    return rollups.state_demand_daily(late)


@query
def corrected_group_rebuild(spark, sf_dir):
    """The second batch moves states to another region: recomputed days keep nothing of the old one."""
    root, rows = new_folder(spark, "layers"), view(spark, sf_dir, "v_batches")
    moved = F.when((F.col("batch") == 1) & F.col("state").endswith("1"), "MOVED").otherwise(F.col("region"))
    mart, table = MARTS[0], silver_table(feeds.STATE_DEMAND)
    for batch in (0, 1):
        part = rows.where(F.col("batch") == batch).withColumn("region", moved).drop("batch")
        merge_into(part.where("source IS NOT NULL"), silver_path(root, feeds.STATE_DEMAND), table)
        refresh_gold(spark, root, mart, late=True)
    return read_table(spark, gold_path(root, mart)).drop(PERIOD, "ingestion_timestamp")


@query
def input_gate(spark, sf_dir):
    days = rollups.national_demand_daily(view(spark, sf_dir, "v_national_demand"))
    needed = [view(spark, sf_dir, name) for name in ("v_fuelmix", "v_frequency")]
    return incremental.input_gate(days, *needed)


@query
def lineage_stamp(spark, sf_dir):
    inputs = [view(spark, sf_dir, n) for n in ("v_national_demand", "v_fuelmix", "v_frequency")]
    return incremental.stamp_lineage(rollups.national_demand_daily(inputs[0]).select("date"), *inputs)


# Rollups


@query
def provenance_counts(spark, sf_dir):
    return view(spark, sf_dir, "v_demand").groupBy("state").agg(*rollups.provenance_counts())


@query
def national_demand_daily(spark, sf_dir):
    return rollups.national_demand_daily(view(spark, sf_dir, "v_national_demand"))


@query
def frequency_daily(spark, sf_dir):
    return rollups.frequency_daily(view(spark, sf_dir, "v_frequency"))


@query
def fuel_daily(spark, sf_dir):
    return rollups.fuel_daily(view(spark, sf_dir, "v_fuelmix"))


@query
def fuel_total(spark, sf_dir):
    return rollups.fuel_total(rollups.fuel_daily(view(spark, sf_dir, "v_fuelmix")))


@query
def fuel_pivot(spark, sf_dir):
    return rollups.fuel_pivot(rollups.fuel_daily(view(spark, sf_dir, "v_fuelmix")))


@query
def fuel_share(spark, sf_dir):
    daily = rollups.fuel_daily(view(spark, sf_dir, "v_fuelmix"))
    return derived.generation_shares(rollups.fuel_mix_daily(daily))


@query
def frequency_deviation(spark, sf_dir):
    daily = rollups.frequency_daily(view(spark, sf_dir, "v_frequency"))
    return derived.frequency_deviation(daily).select("date", "frequency_deviation_hz")


@query
def demand_hourly(spark, sf_dir):
    return rollups.demand_hourly(view(spark, sf_dir, "v_demand"))


@query
def weather_hourly(spark, sf_dir):
    return rollups.weather_hourly(view(spark, sf_dir, "v_weather"))


@query
def normalized_key_join(spark, sf_dir):
    demand = rollups.demand_hourly(view(spark, sf_dir, "v_demand"))
    weather = rollups.weather_hourly(view(spark, sf_dir, "v_weather"))
    return demand.join(weather, ["state_key", "hour"]).select(
        "state_key", "hour", "demand_observations", "temperature"
    )


@query
def adequacy_first_url(spark, sf_dir):
    daily = rollups.adequacy_daily(view(spark, sf_dir, "v_psp"))
    return daily.select("date", "region", "state", "source_url")


# Marts and chains


@query
def state_demand_mart(spark, sf_dir):
    return marts.state_demand_mart(view(spark, sf_dir, "v_demand"))


@query
def state_demand_local_days(spark, sf_dir):
    return marts.state_demand_mart(view(spark, sf_dir, "v_demand"), tz="Asia/Kolkata")


@query
def national_grid_mart(spark, sf_dir):
    return marts.national_grid_mart(
        *[view(spark, sf_dir, n) for n in ("v_national_demand", "v_fuelmix", "v_frequency")]
    )


@query
def adequacy_mart(spark, sf_dir):
    return marts.state_adequacy_mart(view(spark, sf_dir, "v_psp"))


@query
def weather_demand_mart(spark, sf_dir):
    return marts.state_weather_demand_mart(
        view(spark, sf_dir, "v_demand"), view(spark, sf_dir, "v_weather")
    )


@query
def silver_chain(spark, sf_dir):
    """Both batches land; Silver holds the first up to a day, and the run adds what is newer."""
    rows = bronze(view(spark, sf_dir, "v_batches"), feeds.STATE_DEMAND)
    stored = rows.where(F.col("ingestion_timestamp") < F.lit(HISTORY))
    silver = observations(stored, feeds.STATE_DEMAND)
    batch = silver_batch(newer_than(rows, silver), feeds.STATE_DEMAND).drop("processed_timestamp")
    return upsert(silver, batch, feeds.STATE_DEMAND.keys)


@query
def silver_stream(spark, sf_dir):
    """Both batches land one after the other, each followed by a run of the stream."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("bronze", "silver", "progress"))
    rows, feed = view(spark, sf_dir, "v_batches"), feeds.STATE_DEMAND
    for batch in (0, 1):
        append_bronze(bronze(rows.where(F.col("batch") == batch), feed), source, feed)
        follow_bronze(spark, source, target, feed, checkpoint).awaitTermination()
    return read_table(spark, target).drop("processed_timestamp", PERIOD)


def moved(time, micros):
    return F.timestamp_micros(F.unix_micros(F.col(time).cast("timestamp")) + micros)


def arrivals(spark, sf_dir, first):
    """(feed, payload rows) of the first run, and of the second, which offers everything again.

    Every payload holds one row of a table. Feeds that are asked for by window get a window of their own
    for each payload: its end is moved by the hash of the row, or for a state, where it ends at the row's
    time, its start.
    """
    for feed, name, history in (
        (feeds.STATE_DEMAND, "v_demand", HISTORY),
        (feeds.WEATHER, "v_weather", HISTORY),
        (feeds.PSP, "v_psp", ORDER_HISTORY),
        (feeds.NATIONAL_DEMAND, "v_national_demand", ORDER_HISTORY),
        (feeds.FUEL_MIX, "v_fuelmix", ORDER_HISTORY),
        (feeds.FREQUENCY, "v_frequency", ORDER_HISTORY),
    ):
        rows, old = view(spark, sf_dir, name), F.col("ingestion_timestamp") < F.lit(history)
        micros = F.pmod(F.xxhash64(*rows.columns), F.lit(2**45))
        if feed.per_state:
            window = request_window(moved("timestamp", -micros))[0], iso_utc(F.col("timestamp"))
        else:
            window = request_window(F.col("ingestion_timestamp"))[0], iso_utc(moved("ingestion_timestamp", micros))
        if feed is feeds.PSP:
            rows = bronze_by_content(rows, feed)
        else:
            rows = bronze(rows, feed, "array" if feed is feeds.FREQUENCY else None, window=window)
        yield feed, rows.where(old) if first else rows


@query
def layers_end_to_end(spark, sf_dir):
    """Two daily runs over all six feeds and four marts; every measure of every row of every mart."""
    root = new_folder(spark, "layers")

    def arrive(arrival):
        feed, rows = arrival
        land(spark, rows, bronze_path(root, feed), feed)

    for first in (True, False):
        together(spark, arrive, arrivals(spark, sf_dir, first))
        refresh_layers(spark, root)
    return reduce(DataFrame.unionByName, [measures(spark, root, mart) for mart in MARTS])


def measures(spark, root, mart):
    """(mart, key, measure, value) of a Gold table, nulls left out."""
    rows = read_table(spark, gold_path(root, mart)).drop(PERIOD, "ingestion_timestamp")
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in sorted(mart.table.keys)])
    kept = [c for c in rows.columns if c not in mart.table.keys]
    values = [F.round(F.col(c).cast("double") * 65536.0).cast("bigint").cast("string").alias(c)
              if c != "source_url" else F.col(c) for c in kept]
    flat = rows.select(key.alias("key"), *values).unpivot("key", kept, "measure", "value")
    return flat.where("value IS NOT NULL").select(F.lit(mart.table.name).alias("mart"), "key", "measure", "value")
