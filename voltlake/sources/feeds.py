"""The six feeds as data: payload shape, Silver columns, required columns and business key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {
    "text": T.StringType(),
    "number": T.DoubleType(),
    "flag": T.BooleanType(),
    "instant": T.TimestampType(),
    "day": T.DateType(),
}


@dataclass(frozen=True)
class Field:
    """One Silver column and the payload field it is read from.

    ``in_record`` fields of a nested feed sit on the record, beside the list of observations.
    """

    name: str
    kind: str
    source: str
    in_record: bool = False


def field(name: str, kind: str, source: str | None = None, in_record: bool = False) -> Field:
    return Field(name, kind, source or name, in_record)


def text_struct(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


@dataclass(frozen=True)
class Feed:
    """Where the observations of a payload are, what each becomes, and what identifies it.

    ``shape`` says how a payload holds its records: ``array`` (a bare list), ``items`` or ``data``
    (an object with that list), ``object`` (the payload is the record) or ``any`` of these, told
    apart payload by payload. With ``nested``, each record in turn holds a list of observations.
    ``grain`` is the time span of one partition of its tables: months for feeds of a few hundred
    observations a day, which would leave a daily partition of a few kilobytes.
    """

    dataset: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    keys: tuple[str, ...]
    shape: str = "any"
    nested: str | None = None
    time: str = "timestamp"
    grain: str = "day"
    per_state: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def outer_fields(self) -> list[str]:
        """Payload fields read beside the nested list rather than inside it."""
        return [f.source for f in self.fields if f.in_record]

    @property
    def record_type(self) -> T.StructType:
        """Type of one record. Leaves are text: no quoted number or late decimal is lost in parsing."""
        inner = text_struct(f.source for f in self.fields if not f.in_record)
        if self.nested is None:
            return inner
        return text_struct(self.outer_fields).add(self.nested, T.ArrayType(inner))

    @property
    def silver_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, TYPES[f.kind]) for f in self.fields]
            + [
                T.StructField("ingestion_timestamp", T.TimestampType()),
                T.StructField("processed_timestamp", T.TimestampType()),
            ]
        )


# Dataset tags, payload field names and Silver column names.
STATE_DEMAND = Feed(
    dataset="state_demand_timeseries",
    nested="points",
    per_state=True,
    fields=(
        field("state", "text", in_record=True),
        field("timestamp", "instant"),
        field("region", "text"),
        field("demand_mw", "number"),
        field("peak_mw", "number"),
        field("frequency_hz", "number"),
        field("source", "text"),
        field("source_type", "text"),
        field("rolling_peak_24mo_mw", "number"),
        field("installed_in_state_mw", "number"),
        field("allocated_share_mw", "number"),
    ),
    required=("timestamp", "state", "demand_mw", "source"),
    keys=("state", "timestamp", "source"),
)

NATIONAL_DEMAND = Feed(
    dataset="national_demand_4min",
    nested="points",
    fields=(
        field("timestamp", "instant", "ts_utc"),
        field("demand_mw", "number"),
        field("source", "text"),
        field("source_url", "text"),
        field("is_provisional", "flag"),
        field("collected_at", "instant"),
    ),
    required=("timestamp", "demand_mw"),
    keys=("timestamp", "source"),
    grain="month",
)

FUEL_MIX = Feed(
    dataset="national_fuelmix_4min",
    nested="points",
    fields=(
        field("timestamp", "instant", "ts_utc"),
        field("fuel", "text"),
        field("mw", "number"),
        field("source", "text"),
        field("source_url", "text"),
        field("is_provisional", "flag"),
        field("collected_at", "instant"),
    ),
    required=("timestamp", "fuel", "mw"),
    keys=("timestamp", "fuel", "source"),
    grain="month",
)

FREQUENCY = Feed(
    dataset="grid_frequency",
    fields=(
        field("timestamp", "instant"),
        field("frequency_hz", "number"),
        field("region", "text"),
    ),
    required=("timestamp", "frequency_hz"),
    keys=("timestamp", "region"),
    grain="month",
)

WEATHER = Feed(
    dataset="weather",
    nested="points",
    per_state=True,
    fields=(
        field("state", "text", in_record=True),
        field("timestamp", "instant", "ts_utc"),
        field("temperature", "number", "temperature_2m"),
        field("apparent_temperature", "number"),
        field("relative_humidity", "number", "relative_humidity_2m"),
        field("dewpoint", "number", "dewpoint_2m"),
        field("wind_speed", "number", "wind_speed_10m"),
        field("wind_direction", "number", "wind_direction_10m"),
        field("surface_pressure", "number"),
        field("cloud_cover", "number"),
        field("precipitation", "number"),
        field("ghi", "number", "ghi_w_m2"),
        field("direct_radiation", "number"),
        field("dni", "number", "dni_w_m2"),
        field("dhi", "number", "dhi_w_m2"),
    ),
    required=("timestamp", "state"),
    keys=("state", "timestamp"),
)

PSP = Feed(
    dataset="posoco_psp",
    shape="items",
    fields=(
        field("date", "day"),
        field("region", "text"),
        field("state", "text"),
        field("peak_demand_mw", "number"),
        field("peak_demand_met_mw", "number"),
        field("peak_shortage_mw", "number"),
        field("energy_met_mu", "number"),
        field("energy_shortage_mu", "number"),
        field("frequency_min_hz", "number"),
        field("frequency_max_hz", "number"),
        field("frequency_avg_hz", "number"),
        field("source_url", "text"),
    ),
    required=("date",),
    keys=("date", "region", "state", "source_url"),
    time="date",
    grain="month",
)

FEEDS = {
    feed.dataset: feed
    for feed in (STATE_DEMAND, NATIONAL_DEMAND, FUEL_MIX, FREQUENCY, WEATHER, PSP)
}

# Hours asked for in each request, and the days a Gold refresh goes back.
REQUEST_HOURS = 48
LOOKBACK_DAYS = 2

# The entities the per-state feeds are fetched for.
STATES = (
    "Andhra Pradesh",
    "Arunachal Pradesh",
    "Assam",
    "Bihar",
    "Chhattisgarh",
    "Goa",
    "Gujarat",
    "Haryana",
    "Himachal Pradesh",
    "Jharkhand",
    "Karnataka",
    "Kerala",
    "Madhya Pradesh",
    "Maharashtra",
    "Manipur",
    "Meghalaya",
    "Mizoram",
    "Nagaland",
    "Odisha",
    "Punjab",
    "Rajasthan",
    "Sikkim",
    "Tamil Nadu",
    "Telangana",
    "Tripura",
    "Uttar Pradesh",
    "Uttarakhand",
    "West Bengal",
    "Andaman and Nicobar Islands",
    "Chandigarh",
    "Dadra and Nagar Haveli and Daman and Diu",
    "Delhi",
    "Jammu and Kashmir",
    "Ladakh",
    "Lakshadweep",
    "Puducherry",
)
