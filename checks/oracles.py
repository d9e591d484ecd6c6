"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.views import with_views

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
HISTORY = "TIMESTAMP '2024-01-20'"
OVERLAP = "TIMESTAMP '2024-01-16'"
ORDER_HISTORY = "TIMESTAMP '1998-01-01'"
FUELS = ("gas", "hydro", "nuclear", "solar", "thermal", "wind")


def iso(time: str) -> str:
    return f"strftime({time}, {ISO})"


def rounded_all(*columns: str) -> str:
    return ", ".join(rounded(c, c) for c in columns)


def rounded(expression: str, name: str) -> str:
    """As in ``checks.queries.present``: a multiple of 2^-16."""
    return f"round(({expression}) * 65536) / 65536 AS {name}"


OBSERVED = f"state, timestamp, source, {rounded("demand_mw", "demand_mw")}, ingestion_timestamp"


def request(end: str = "ingestion_timestamp", hours: int = 48) -> str:
    return (
        f"{iso(f'{end} - INTERVAL {hours} HOUR')} AS from_timestamp, {iso(end)} AS to_timestamp"
    )


def envelope(dataset: str, hours: bool = True) -> str:
    count = ", CAST(48 AS BIGINT) AS hours" if hours else ""
    return f"'grid_api' AS source, '{dataset}' AS dataset, {request()}{count}, ingestion_timestamp"


def best(relation: str, keys: str, order: str) -> str:
    """Rows of ``relation`` that come first within their key."""
    return (
        f"(SELECT * FROM {relation} QUALIFY "
        f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"
    )


# Each list of a payload holds the observation, then the same one with an unreadable time.
TWICE = "(SELECT unnest([true, false]) AS readable)"


def frequency_records(rows: str = f"v_frequency, {TWICE}", time: str | None = None) -> str:
    time = time or f"CASE WHEN readable THEN {iso('timestamp')} ELSE 'n/a' END"
    return with_views(
        "v_frequency",
        then=f"""
        SELECT 'grid_frequency' AS dataset, ingestion_timestamp, {time} AS timestamp,
          {rounded("frequency_hz", "frequency_hz")}, region FROM {rows}""",
    )


STATE_DAILY = f"""
    state, region, CAST(timestamp AS DATE) AS date, {rounded("avg(demand_mw)", "avg_demand_mw")},
    {rounded("max(demand_mw)", "peak_demand_mw")}, {rounded("min(demand_mw)", "min_demand_mw")},
    {rounded("max(demand_mw) - min(demand_mw)", "demand_range_mw")},
    {rounded("avg(frequency_hz)", "avg_frequency_hz")}, count(*) AS observations,
    count(*) FILTER (WHERE source_type = 'official') AS official_observations,
    count(*) FILTER (WHERE source_type = 'modeled') AS modeled_observations,
    max(installed_in_state_mw) AS installed_in_state_mw,
    max(allocated_share_mw) AS allocated_share_mw,
    max(rolling_peak_24mo_mw) AS rolling_peak_24mo_mw"""


def state_daily(relation: str, where: str = "true", stamp: str = "") -> str:
    stamp = stamp and f", {stamp} AS ingestion_timestamp"
    return f"""SELECT {STATE_DAILY}{stamp} FROM {relation} WHERE {where}
      GROUP BY state, region, CAST(timestamp AS DATE)"""


def newest(relation: str, where: str = "true") -> str:
    return f"(SELECT max(ingestion_timestamp) FROM {relation} WHERE {where})"


NEWEST_OF_THREE = (
    f"greatest({newest('v_national_demand')}, {newest('v_fuelmix')}, {newest('v_frequency')})"
)

DEMAND_DAILY = f"""
    SELECT CAST(timestamp AS DATE) AS date, {rounded("avg(demand_mw)", "avg_national_demand_mw")},
      {rounded("max(demand_mw)", "peak_national_demand_mw")},
      {rounded("min(demand_mw)", "min_national_demand_mw")},
      count(*) AS demand_observations
    FROM v_national_demand GROUP BY CAST(timestamp AS DATE)"""

FREQUENCY_DAILY = """
    SELECT CAST(timestamp AS DATE) AS date, avg(frequency_hz) AS avg_frequency_hz,
      min(frequency_hz) AS min_frequency_hz, max(frequency_hz) AS max_frequency_hz,
      count(*) AS frequency_observations
    FROM v_frequency GROUP BY CAST(timestamp AS DATE)"""

FUEL_DAILY = """
    SELECT CAST(timestamp AS DATE) AS date, fuel, avg(mw) AS avg_mw
    FROM v_fuelmix GROUP BY CAST(timestamp AS DATE), fuel"""

FREQUENCY_COLUMNS = rounded_all("avg_frequency_hz", "min_frequency_hz", "max_frequency_hz")
FUEL_COLUMNS = ", ".join(f"max(avg_mw) FILTER (WHERE fuel = '{fuel}') AS {fuel}" for fuel in FUELS)
FUEL_ROUNDED = rounded_all(*FUELS)

MIX = f"SELECT date, {FUEL_COLUMNS}, sum(avg_mw) AS total FROM ({FUEL_DAILY}) GROUP BY date"
RENEWABLE = "(coalesce(hydro, 0) + coalesce(solar, 0) + coalesce(wind, 0))"
SHARES = f"""{FUEL_ROUNDED}, {rounded("total", "total_generation_mw")},
    {rounded(f"{RENEWABLE}", "renewable_generation_mw")},
    {rounded("coalesce(thermal, 0)", "thermal_generation_mw")},
    {rounded(f"CASE WHEN total > 0 THEN {RENEWABLE} / total * 100 END", "renewable_share_pct")},
    {rounded("CASE WHEN total > 0 THEN coalesce(thermal, 0) / total * 100 END", "thermal_share_pct")}"""

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
HOUR_KEY = "lower(trim(state)) AS state_key, date_trunc('hour', timestamp) AS hour"
DEMAND_MEASURES = """avg(demand_mw) AS avg_demand_mw, max(demand_mw) AS peak_demand_mw,
    min(demand_mw) AS min_demand_mw, count(*) AS demand_observations"""
WEATHER_AVERAGES = ", ".join(f"avg({m}) AS {m}" for m in WEATHER_MEASURES)
WEATHER_ROUNDED = rounded_all(*WEATHER_MEASURES)
DEMAND_HOURLY = f"SELECT {HOUR_KEY}, {DEMAND_MEASURES} FROM v_demand GROUP BY ALL"
OFFICIAL_HOURLY = f"""SELECT {HOUR_KEY}, {DEMAND_MEASURES} FROM v_demand
    WHERE source_type = 'official' GROUP BY ALL"""
WEATHER_HOURLY = f"SELECT {HOUR_KEY}, {WEATHER_AVERAGES} FROM v_weather GROUP BY ALL"
DEMAND_ROUNDED = (
    f"{rounded_all('avg_demand_mw', 'peak_demand_mw', 'min_demand_mw')}, demand_observations"
)

ADEQUACY = (
    "peak_demand_mw",
    "peak_demand_met_mw",
    "peak_shortage_mw",
    "energy_met_mu",
    "energy_shortage_mu",
    "frequency_min_hz",
    "frequency_max_hz",
    "frequency_avg_hz",
)
DEMAND_MET = "CASE WHEN peak_demand_mw > 0 THEN peak_demand_met_mw / peak_demand_mw * 100 END"
ENERGY_SHORTAGE = """CASE WHEN energy_met_mu + energy_shortage_mu > 0
    THEN energy_shortage_mu / (energy_met_mu + energy_shortage_mu) * 100 END"""
ADEQUACY_DAILY = f"""SELECT date, region, state, {', '.join(f'max({m}) AS {m}' for m in ADEQUACY)},
    min(source_url) AS source_url FROM v_psp GROUP BY date, region, state"""

# The two batches of the upsert queries: what is stored, and what arrives over it.
BATCHES = f"""stored AS (SELECT {OBSERVED} FROM v_batches WHERE batch = 0 AND timestamp < {HISTORY}),
    arriving AS (SELECT {OBSERVED} FROM v_batches WHERE batch = 1 AND timestamp >= {OVERLAP})"""


def upserted(same: str) -> str:
    ctes = with_views("v_batches", then="")
    return f"""{ctes}, {BATCHES} SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM arriving a
      WHERE a.state {same} s.state AND a.timestamp {same} s.timestamp AND a.source {same} s.source)
      UNION ALL SELECT * FROM arriving"""


NULL_SAFE = upserted("IS NOT DISTINCT FROM")
FIRST_BATCH = with_views("v_batches", then=f"SELECT {OBSERVED} FROM v_batches WHERE batch = 0")

HOURLY_REQUESTS = f"""
    SELECT 'grid_api' AS source, 'state_demand_timeseries' AS dataset,
      {request("(date_trunc('hour', timestamp) + INTERVAL 1 HOUR)", 1)}, state,
      timestamp < {OVERLAP} - INTERVAL 1 HOUR OR region IN ('ASIA', 'EUROPE') AS landed
    FROM v_demand"""

IN_WINDOW = """from_timestamp = '2024-01-05T10:00:00.000000Z'
      AND to_timestamp = '2024-01-05T11:00:00.000000Z'"""

DEMAND_COLUMNS = f"""state, timestamp, region, {rounded("demand_mw", "demand_mw")},
    {rounded("peak_mw", "peak_mw")}, {rounded("frequency_hz", "frequency_hz")}, source, source_type,
    rolling_peak_24mo_mw, installed_in_state_mw, allocated_share_mw, ingestion_timestamp"""

# The four marts over whole feeds.
STATE_MART = state_daily("v_demand", stamp=newest("v_demand"))
GRID_MART = f"""SELECT d.*, {FREQUENCY_COLUMNS}, frequency_observations, m.* EXCLUDE (date),
            {rounded("abs(avg_frequency_hz - 50)", "frequency_deviation_hz")},
            {NEWEST_OF_THREE} AS ingestion_timestamp
          FROM ({DEMAND_DAILY}) d LEFT JOIN ({FREQUENCY_DAILY}) f USING (date)
          LEFT JOIN (SELECT date, {SHARES} FROM ({MIX})) m USING (date)
          WHERE (SELECT count(*) FROM v_fuelmix) > 0 AND (SELECT count(*) FROM v_frequency) > 0"""
ADEQUACY_MART = f"""SELECT date, region, state, {rounded_all(*ADEQUACY)}, source_url,
            {rounded("peak_demand_mw - peak_demand_met_mw", "peak_demand_gap_mw")},
            {rounded(DEMAND_MET, "demand_met_pct")}, {rounded(ENERGY_SHORTAGE, "energy_shortage_pct")},
            {rounded("frequency_max_hz - frequency_min_hz", "frequency_range_hz")},
            {newest("v_psp")} AS ingestion_timestamp
          FROM ({ADEQUACY_DAILY})"""
WEATHER_MART = f"""SELECT state_key, hour, {DEMAND_ROUNDED}, {WEATHER_ROUNDED},
            {rounded("apparent_temperature - temperature", "apparent_temperature_delta_c")},
            greatest({newest("v_demand", "source_type = 'official'")}, {newest("v_weather")})
              AS ingestion_timestamp
          FROM ({OFFICIAL_HOURLY}) JOIN ({WEATHER_HOURLY}) USING (state_key, hour)"""

ORACLES: dict[str, str] = {
    "bronze_scan": with_views(
        "v_demand",
        then=f"""
        SELECT {envelope("state_demand_timeseries")}, state, {iso("timestamp")} AS first_timestamp,
          {rounded("demand_mw", "first_demand_mw")}, 'n/a' AS second_timestamp FROM v_demand""",
    ),
    "envelope_build": with_views(
        "v_weather",
        then=f"""
        SELECT {envelope("weather")}, state, CAST(2 AS BIGINT) AS n_points,
          {iso("timestamp")} AS first_ts_utc FROM v_weather""",
    ),
    "land_window_dedup": with_views(
        "v_national_demand",
        then=f"""
        SELECT DISTINCT {envelope("national_demand_4min")} FROM v_national_demand""",
    ),
    "land_entity_dedup": with_views(
        "v_demand",
        then=f"""
        SELECT DISTINCT source, dataset, from_timestamp, to_timestamp, state FROM ({HOURLY_REQUESTS})""",
    ),
    "land_hash_dedup": f"""
        SELECT 'grid_api' AS source, 'posoco_psp' AS dataset, min(ts) AS ingestion_timestamp, user_id,
          CAST(floor(value) AS BIGINT) AS amount
        FROM events GROUP BY user_id, CAST(floor(value) AS BIGINT)""",
    "landed_entities": with_views(
        "v_demand", then=f"SELECT DISTINCT state FROM ({HOURLY_REQUESTS}) WHERE {IN_WINDOW}"
    ),
    "missing_entities": with_views(
        "v_demand",
        then=f"""SELECT n_name AS state FROM nation WHERE n_name NOT IN
          (SELECT state FROM ({HOURLY_REQUESTS}) WHERE {IN_WINDOW})""",
    ),
    "infer_payload_schema": with_views(
        "v_psp",
        then="""
        , payload AS (SELECT to_json(v) AS j FROM v_psp v),
        parts AS (SELECT unnest(json_keys(j)) AS field, j FROM payload)
        SELECT field, CASE WHEN bool_or(json_type(j, field) = 'VARCHAR') THEN 'text'
          WHEN bool_or(json_type(j, field) = 'BOOLEAN') THEN 'flag'
          WHEN bool_or(TRY_CAST(j ->> field AS DOUBLE) <> floor(TRY_CAST(j ->> field AS DOUBLE)))
          THEN 'fraction' ELSE 'whole' END AS kind
        FROM parts WHERE field <> 'ingestion_timestamp' GROUP BY field""",
    ),
    "shape_errors": with_views(
        "v_frequency",
        then="""SELECT 'table' AS shape, 'Unsupported payload shape: table' AS message, count(*) AS n_rows
          FROM v_frequency
          UNION ALL SELECT 'none', 'Bronze rows have no raw_response column', count(*) FROM v_frequency""",
    ),
    "flatten_array": frequency_records(),
    "flatten_data": frequency_records(),
    "flatten_undeclared": frequency_records(),
    "unreadable_payloads": with_views(
        "v_frequency",
        then="""SELECT 'grid_frequency' AS dataset, ingestion_timestamp, '{"data": [' AS raw_response
          FROM v_frequency WHERE region IS NULL""",
    ),
    "rejected_payloads": with_views(
        "v_frequency",
        then="""SELECT 'grid_frequency' AS dataset,
            CASE WHEN region IS NULL THEN ingestion_timestamp END AS ingestion_timestamp,
            CASE WHEN region IS NULL THEN '{"data": [' ELSE '{"source": "grid_api", "dat' END AS raw_response,
            CASE WHEN region IS NULL THEN 'payload' ELSE 'line' END AS reason
          FROM v_frequency WHERE region IS NULL OR region = 'South'""",
    ),
    "processed_stamp": with_views(
        "v_demand", then="SELECT state, timestamp, source, true AS stamped_in_run FROM v_demand"
    ),
    "flatten_object": frequency_records("v_frequency", iso("timestamp")),
    "flatten_items": with_views(
        "v_psp",
        then=f"""
        SELECT 'posoco_psp' AS dataset, ingestion_timestamp,
          CASE WHEN readable THEN strftime(date, '%Y-%m-%d') ELSE 'n/a' END AS date, region, state,
          {rounded_all(*ADEQUACY)}, source_url
        FROM v_psp, {TWICE}""",
    ),
    "flatten_points": with_views(
        "v_demand",
        then=f"""
        SELECT state, CASE WHEN readable THEN {iso("timestamp")} ELSE 'n/a' END AS timestamp, region,
          {rounded("demand_mw", "demand_mw")}, source_type FROM v_demand, {TWICE}""",
    ),
    "flatten_outer_nulls": with_views(
        "v_frequency",
        then=f"""
        SELECT ingestion_timestamp, CASE WHEN readable THEN {iso("timestamp")} ELSE 'n/a' END AS timestamp,
          region FROM v_frequency, {TWICE} WHERE region = 'North'
        UNION ALL SELECT ingestion_timestamp, NULL, NULL FROM v_frequency
        WHERE region IS NULL OR region = 'South'""",
    ),
    "flatten_metadata": with_views(
        "v_demand",
        then=f"""
        SELECT 'grid_api' AS bronze_source, 'state_demand_timeseries' AS dataset, {request()},
          CAST(48 AS BIGINT) AS hours, ingestion_timestamp, source,
          CASE WHEN readable THEN {iso("timestamp")} ELSE 'n/a' END AS timestamp FROM v_demand, {TWICE}""",
    ),
    "conform_state_demand": with_views("v_demand", then=f"SELECT {DEMAND_COLUMNS} FROM v_demand"),
    "conform_national_demand": with_views(
        "v_national_demand",
        then=f"SELECT * REPLACE ({rounded_all('demand_mw')}) FROM v_national_demand",
    ),
    "conform_fuelmix": with_views("v_fuelmix", then="SELECT * FROM v_fuelmix"),
    "conform_frequency": with_views(
        "v_frequency",
        then=f"""SELECT timestamp, {rounded("frequency_hz", "frequency_hz")}, region, ingestion_timestamp
          FROM v_frequency""",
    ),
    "conform_weather": with_views(
        "v_weather",
        then=f"""SELECT state, timestamp, {WEATHER_ROUNDED},
          {rounded("wind_direction", "wind_direction")}, ingestion_timestamp FROM v_weather""",
    ),
    "conform_psp": with_views(
        "v_psp",
        then=f"""SELECT date, region, state, {rounded_all(*ADEQUACY)}, source_url,
          ingestion_timestamp FROM v_psp""",
    ),
    "dedupe_latest": with_views(
        "v_fuelmix",
        then="SELECT * FROM "
        + best(
            "v_fuelmix",
            "timestamp, fuel, source",
            "ingestion_timestamp DESC, mw DESC, source_url DESC, is_provisional DESC",
        ),
    ),
    "upsert_bootstrap": FIRST_BATCH,
    "upsert_empty_batch": FIRST_BATCH,
    "upsert_out_of_order": with_views(
        "v_batches",
        then=f"SELECT {OBSERVED} FROM "
        + best("v_batches", "state, timestamp, source", "ingestion_timestamp DESC"),
    ),
    "upsert_wider_batch": with_views(
        "v_batches",
        then=f"SELECT {OBSERVED}, CASE WHEN batch = 1 THEN region END AS region FROM "
        + best("v_batches", "state, timestamp, source", "ingestion_timestamp DESC"),
    ),
    "upsert_merge": NULL_SAFE,
    "upsert_null_safe": NULL_SAFE,
    "upsert_plain_keys": upserted("="),
    "incremental_watermark": with_views(
        "v_batches",
        then=f"""SELECT {OBSERVED} FROM v_batches WHERE ingestion_timestamp >
          (SELECT max(ingestion_timestamp) FROM v_batches WHERE batch = 0 AND timestamp < {HISTORY})""",
    ),
    "incremental_filtered": with_views(
        "v_demand",
        then=f"""SELECT lower(trim(state)) AS state_key, timestamp,
            {rounded("demand_mw", "demand_mw")}, source_type FROM v_demand
          WHERE source_type = 'official' AND demand_mw > 10 AND CAST(timestamp AS DATE) >=
          (SELECT max(CAST(timestamp AS DATE)) - 2 FROM v_demand WHERE timestamp < {HISTORY})""",
    ),
    "rolling_rebuild": with_views(
        "v_demand",
        then=f""", cut AS (SELECT max(CAST(timestamp AS DATE)) - 2 AS day FROM v_demand
            WHERE timestamp < {HISTORY})
          {state_daily("v_demand", "CAST(timestamp AS DATE) < (SELECT day FROM cut)",
                       newest("v_demand", f"timestamp < {HISTORY}"))}
          UNION ALL
          {state_daily("v_demand", "CAST(timestamp AS DATE) >= (SELECT day FROM cut)", newest("v_demand"))}
        """,
    ),
    "touched_dates_rebuild": with_views(
        "v_batches",
        then=state_daily(
            "v_batches",
            f"""CAST(timestamp AS DATE) IN (SELECT CAST(timestamp AS DATE) FROM v_batches
              WHERE ingestion_timestamp >= {OVERLAP})""",
        ),
    ),
    "corrected_group_rebuild": with_views(
        "v_batches",
        then=state_daily(
            """(SELECT * REPLACE (CASE WHEN state LIKE '%1' THEN 'MOVED' ELSE region END AS region)
              FROM v_batches WHERE batch = 1 AND source IS NOT NULL)"""
        ),
    ),
    "input_gate": with_views(
        "v_national_demand",
        "v_fuelmix",
        "v_frequency",
        then=f"""SELECT * FROM ({DEMAND_DAILY}) WHERE (SELECT count(*) FROM v_fuelmix) > 0
          AND (SELECT count(*) FROM v_frequency) > 0""",
    ),
    "lineage_stamp": with_views(
        "v_national_demand",
        "v_fuelmix",
        "v_frequency",
        then=f"SELECT date, {NEWEST_OF_THREE} AS ingestion_timestamp FROM ({DEMAND_DAILY})",
    ),
    "provenance_counts": with_views(
        "v_demand",
        then="""SELECT state, count(*) AS observations,
          count(*) FILTER (WHERE source_type = 'official') AS official_observations,
          count(*) FILTER (WHERE source_type = 'modeled') AS modeled_observations
          FROM v_demand GROUP BY state""",
    ),
    "national_demand_daily": with_views("v_national_demand", then=DEMAND_DAILY),
    "frequency_daily": with_views(
        "v_frequency",
        then=f"SELECT date, {FREQUENCY_COLUMNS}, frequency_observations FROM ({FREQUENCY_DAILY})",
    ),
    "fuel_daily": with_views(
        "v_fuelmix", then=f"SELECT date, fuel, {rounded("avg_mw", "avg_mw")} FROM ({FUEL_DAILY})"
    ),
    "fuel_total": with_views(
        "v_fuelmix",
        then=f"""SELECT date, {rounded("sum(avg_mw)", "total_generation_mw")}
          FROM ({FUEL_DAILY}) GROUP BY date""",
    ),
    "fuel_pivot": with_views("v_fuelmix", then=f"SELECT date, {FUEL_ROUNDED} FROM ({MIX})"),
    "fuel_share": with_views("v_fuelmix", then=f"SELECT date, {SHARES} FROM ({MIX})"),
    "frequency_deviation": with_views(
        "v_frequency",
        then=f"""SELECT date, {rounded("abs(avg_frequency_hz - 50)", "frequency_deviation_hz")}
          FROM ({FREQUENCY_DAILY})""",
    ),
    "demand_hourly": with_views(
        "v_demand", then=f"SELECT state_key, hour, {DEMAND_ROUNDED} FROM ({DEMAND_HOURLY})"
    ),
    "weather_hourly": with_views(
        "v_weather", then=f"SELECT state_key, hour, {WEATHER_ROUNDED} FROM ({WEATHER_HOURLY})"
    ),
    "normalized_key_join": with_views(
        "v_demand",
        "v_weather",
        then=f"""SELECT state_key, hour, demand_observations, {rounded("temperature", "temperature")}
          FROM ({DEMAND_HOURLY}) JOIN ({WEATHER_HOURLY}) USING (state_key, hour)""",
    ),
    "adequacy_first_url": with_views(
        "v_psp", then=f"SELECT date, region, state, source_url FROM ({ADEQUACY_DAILY})"
    ),
    "state_demand_mart": with_views("v_demand", then=STATE_MART),
    "national_grid_mart": with_views(
        "v_national_demand",
        "v_fuelmix",
        "v_frequency",
        then=GRID_MART,
    ),
    "adequacy_mart": with_views(
        "v_psp",
        then=ADEQUACY_MART,
    ),
    "weather_demand_mart": with_views(
        "v_demand",
        "v_weather",
        then=WEATHER_MART,
    ),
    "state_demand_local_days": with_views(
        "v_demand",
        then=state_daily(
            "(SELECT * REPLACE (timestamp + INTERVAL 330 MINUTE AS timestamp) FROM v_demand)",
            stamp=newest("v_demand"),
        ),
    ),
    "silver_chain": with_views(
        "v_batches",
        then=f"SELECT {DEMAND_COLUMNS} FROM "
        + best("v_batches", "state, timestamp, source", "ingestion_timestamp DESC")
        + " WHERE source IS NOT NULL",
    ),
}


ORACLES["silver_stream"] = ORACLES["silver_chain"]


# Silver keeps one row per key, so the marts of the full chain start from deduplicated feeds.
DEDUPED = {
    "v_demand": ("state, timestamp, source", "demand_mw DESC"),
    "v_weather": ("state, timestamp", "temperature DESC"),
    "v_national_demand": ("timestamp, source", "demand_mw DESC"),
    "v_fuelmix": ("timestamp, fuel, source", "mw DESC"),
    "v_frequency": ("timestamp, region", "frequency_hz DESC"),
    "v_psp": (
        "date, region, state, source_url",
        "peak_demand_mw DESC, peak_demand_met_mw DESC NULLS LAST",
    ),
}
MART_KEYS = {
    "state_demand": (STATE_MART, ("date", "region", "state")),
    "national_grid": (GRID_MART, ("date",)),
    "state_adequacy": (ADEQUACY_MART, ("date", "region", "state")),
    "state_weather_demand": (WEATHER_MART, ("hour", "state_key")),
}


def _measures(mart: str) -> str:
    """(mart, key, measure, value) of every value that is not null."""
    body, keys = MART_KEYS[mart]
    parts = [
        f"coalesce({'strftime(hour, $fmt$%Y-%m-%d %H:%M:%S$fmt$)' if k == 'hour' else f'CAST({k} AS VARCHAR)'}, '-')"
        for k in keys
    ]
    text = ", source_url" if mart == "state_adequacy" else ""
    numbers = f"COLUMNS(* EXCLUDE ({', '.join(keys)}{text}, ingestion_timestamp))"
    return f"""SELECT '{mart}' AS mart, key, measure, value FROM (
      UNPIVOT (SELECT concat_ws('|', {', '.join(parts)}) AS key{text},
          CAST(CAST(round(CAST({numbers} AS DOUBLE) * 65536) AS BIGINT) AS VARCHAR)
        FROM ({body})) ON COLUMNS(* EXCLUDE (key)) INTO NAME measure VALUE value)"""


def _end_to_end() -> str:
    text = with_views(*DEDUPED, then="")
    for name in DEDUPED:
        text = text.replace(f"{name} AS (", f"{name}_all AS (", 1)
    kept = ", ".join(f"{n} AS {best(f'{n}_all', *how)}" for n, how in DEDUPED.items())
    return f"{text}, {kept} {' UNION ALL '.join(map(_measures, MART_KEYS))}"


ORACLES["layers_end_to_end"] = _end_to_end()
