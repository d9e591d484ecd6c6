"""Daily and hourly rollups.

Every aggregate here keeps a fixed-width buffer, so Spark plans hash aggregation with a map-side
partial step: a day, state or fuel holding a third of all rows shuffles as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.functions import hour_of, local_day, normalized_key

# The fuels with a column of their own, and the provenance labels.
FUELS = ("gas", "hydro", "nuclear", "solar", "thermal", "wind")
OFFICIAL = "official"
MODELED = "modeled"

# The weather measures averaged per hour.
WEATHER_MEASURES = (
    "temperature",
    "apparent_temperature",
    "relative_humidity",
    "dewpoint",
    "wind_speed",
    "surface_pressure",
    "cloud_cover",
    "precipitation",
    "ghi",
    "direct_radiation",
    "dni",
    "dhi",
)

# The adequacy measures of which the day's maximum is kept.
ADEQUACY_MEASURES = (
    "peak_demand_mw",
    "peak_demand_met_mw",
    "peak_shortage_mw",
    "energy_met_mu",
    "energy_shortage_mu",
    "frequency_min_hz",
    "frequency_max_hz",
    "frequency_avg_hz",
)


#: Newest ingest time of the rows of a group, if a rollup is ``stamped``. It comes first among the aggregates, as in
#: the rows that the stamp of a mart is taken from: in another order it would be another exchange to Spark.
NEWEST = "_newest"


def newest(stamped: bool, column: str = "ingestion_timestamp") -> list[Column]:
    return [F.max(F.col(column).cast("timestamp")).alias(NEWEST)] if stamped else []


def day_column(tz: str | None = None) -> Column:
    return local_day(F.col("timestamp"), tz).alias("date")


def hour_column(tz: str | None = None) -> Column:
    return hour_of(F.col("timestamp"), tz).alias("hour")


def provenance_counts() -> list[Column]:
    """All, official and modeled observations of a group; other or no provenance counts in neither."""
    kind = F.col("source_type")
    return [
        F.count(F.lit(1)).alias("observations"),
        F.count_if(kind == OFFICIAL).alias("official_observations"),
        F.count_if(kind == MODELED).alias("modeled_observations"),
    ]


def state_demand_daily(demand: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """Demand, frequency, provenance and capacity by state, region and day."""
    mw = F.col("demand_mw")
    return demand.groupBy("state", "region", day_column(tz)).agg(
        *newest(stamped),
        F.avg(mw).alias("avg_demand_mw"),
        F.max(mw).alias("peak_demand_mw"),
        F.min(mw).alias("min_demand_mw"),
        (F.max(mw) - F.min(mw)).alias("demand_range_mw"),
        F.avg("frequency_hz").alias("avg_frequency_hz"),
        *provenance_counts(),
        F.max("installed_in_state_mw").alias("installed_in_state_mw"),
        F.max("allocated_share_mw").alias("allocated_share_mw"),
        F.max("rolling_peak_24mo_mw").alias("rolling_peak_24mo_mw"),
    )


def national_demand_daily(demand: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """National demand by day, all sources together."""
    return demand.groupBy(day_column(tz)).agg(
        *newest(stamped),
        F.avg("demand_mw").alias("avg_national_demand_mw"),
        F.max("demand_mw").alias("peak_national_demand_mw"),
        F.min("demand_mw").alias("min_national_demand_mw"),
        F.count(F.lit(1)).alias("demand_observations"),
    )


def frequency_daily(frequency: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """Grid frequency by day, all regions together."""
    return frequency.groupBy(day_column(tz)).agg(
        *newest(stamped),
        F.avg("frequency_hz").alias("avg_frequency_hz"),
        F.min("frequency_hz").alias("min_frequency_hz"),
        F.max("frequency_hz").alias("max_frequency_hz"),
        F.count(F.lit(1)).alias("frequency_observations"),
    )


def fuel_daily(fuelmix: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """Average generation by day and fuel."""
    return fuelmix.groupBy(day_column(tz), "fuel").agg(*newest(stamped), F.avg("mw").alias("avg_mw"))


def fuel_total(daily: DataFrame) -> DataFrame:
    """Sum of the daily averages of all fuels, listed in ``FUELS`` or not."""
    return daily.groupBy("date").agg(_total())


def fuel_pivot(daily: DataFrame, fuels: Sequence[str] = FUELS) -> DataFrame:
    """One column per listed fuel; null where a day lacks it, nothing for unlisted fuels."""
    return daily.groupBy("date").agg(*_per_fuel(fuels))


def fuel_mix_daily(daily: DataFrame, fuels: Sequence[str] = FUELS) -> DataFrame:
    """Pivot and total in one pass: conditional aggregates need no second scan and no join."""
    stamp = newest(NEWEST in daily.columns, NEWEST)
    return daily.groupBy("date").agg(*stamp, *_per_fuel(fuels), _total())


def adequacy_daily(psp: DataFrame, stamped: bool = False) -> DataFrame:
    """Largest value of each measure by day, region and state, with the first source URL by name.

    The URL is text, and one text aggregate turns the whole rollup into a sort of its input. So the
    measures are first hash-aggregated with the URL as a key; only the few rows left are sorted.
    """
    measures = [F.max(name).alias(name) for name in ADEQUACY_MEASURES]
    keys = ["date", "region", "state"]
    per_url = psp.groupBy(*keys, "source_url").agg(*newest(stamped), *measures)
    return per_url.groupBy(*keys).agg(
        *newest(stamped, NEWEST), *measures, F.min("source_url").alias("source_url")
    )


def demand_hourly(demand: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """Demand by normalized state and hour."""
    return demand.groupBy(state_key(), hour_column(tz)).agg(
        *newest(stamped),
        F.avg("demand_mw").alias("avg_demand_mw"),
        F.max("demand_mw").alias("peak_demand_mw"),
        F.min("demand_mw").alias("min_demand_mw"),
        F.count(F.lit(1)).alias("demand_observations"),
    )


def weather_hourly(weather: DataFrame, tz: str | None = None, stamped: bool = False) -> DataFrame:
    """Weather averages by normalized state and hour."""
    return weather.groupBy(state_key(), hour_column(tz)).agg(
        *newest(stamped), *[F.avg(name).alias(name) for name in WEATHER_MEASURES]
    )


def state_key() -> Column:
    return normalized_key(F.col("state")).alias("state_key")


def _per_fuel(fuels: Sequence[str]) -> list[Column]:
    return [F.max(F.when(F.col("fuel") == fuel, F.col("avg_mw"))).alias(fuel) for fuel in fuels]


def _total() -> Column:
    return F.sum("avg_mw").alias("total_generation_mw")
