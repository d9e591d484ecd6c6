"""Feed-shaped views over the given tables, in one SQL text for Spark and DuckDB.

Every view covers its whole tables. Names in braces are tables (``{events}``) or the few expressions
the two dialects spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SPARK = {
    "json_k": "CAST(get_json_object(e.props, '$.k') AS DOUBLE)",
    "ntz": "TIMESTAMP_NTZ",
    "batches": "explode(array(0, 1))",
}
DUCKDB = {
    "json_k": "CAST(json_extract_string(e.props, '$.k') AS DOUBLE)",
    "ntz": "TIMESTAMP",
    "batches": "unnest([0, 1])",
}

VIEWS = {
    "v_demand": """
        SELECT n.n_name AS state, r.r_name AS region, e.ts AS timestamp, e.value AS demand_mw,
          e.value * CAST(1.1 AS DOUBLE) AS peak_mw,
          CAST(50 AS DOUBLE) + ({json_k} - CAST(50 AS DOUBLE)) / CAST(100 AS DOUBLE) AS frequency_hz,
          e.event_type AS source,
          CASE WHEN e.event_type IN ('purchase', 'view') THEN 'official'
               WHEN e.event_type IN ('click', 'signup') THEN 'modeled' END AS source_type,
          CAST(500 AS DOUBLE) AS rolling_peak_24mo_mw,
          CAST(400 + n.n_nationkey AS DOUBLE) AS installed_in_state_mw,
          CASE WHEN n.n_regionkey <> 0 THEN CAST(100 + n.n_nationkey AS DOUBLE) END AS allocated_share_mw,
          CAST(CAST(e.ts AS DATE) AS {ntz}) + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {events} e
        JOIN {nation} n ON n.n_nationkey = e.user_id % 25
        JOIN {region} r ON r.r_regionkey = n.n_regionkey
    """,
    # Weather readings come six hours after the demand of the same state, so some hours do not match.
    "v_weather": """
        SELECT CASE WHEN e.event_type IN ('error', 'view') THEN concat('  ', lower(n.n_name))
                    ELSE concat(n.n_name, ' ') END AS state,
          e.ts + INTERVAL '6' HOUR AS timestamp, {json_k} AS temperature,
          {json_k} + e.value / CAST(100 AS DOUBLE) AS apparent_temperature,
          CAST(e.user_id AS DOUBLE) AS relative_humidity,
          {json_k} - CAST(5 AS DOUBLE) AS dewpoint,
          e.value / CAST(10 AS DOUBLE) AS wind_speed,
          e.value * CAST(2 AS DOUBLE) AS wind_direction,
          CAST(1000 AS DOUBLE) + {json_k} AS surface_pressure,
          {json_k} / CAST(2 AS DOUBLE) AS cloud_cover,
          CASE WHEN e.event_type = 'click' THEN e.value END AS precipitation,
          e.value AS ghi, e.value / CAST(2 AS DOUBLE) AS direct_radiation,
          e.value / CAST(4 AS DOUBLE) AS dni, e.value / CAST(8 AS DOUBLE) AS dhi,
          CAST(CAST(e.ts AS DATE) AS {ntz}) + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {events} e JOIN {nation} n ON n.n_nationkey = e.user_id % 25
    """,
    "v_national_demand": """
        SELECT o_orderdate AS timestamp, o_totalprice AS demand_mw, o_orderpriority AS source,
          concat('feed/', o_orderstatus) AS source_url, o_orderstatus = 'P' AS is_provisional,
          o_orderdate + INTERVAL '1' HOUR AS collected_at,
          o_orderdate + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {orders}
    """,
    "v_fuelmix": """
        SELECT l.l_shipdate AS timestamp,
          CASE p.p_type WHEN 'ECONOMY' THEN 'gas' WHEN 'LARGE' THEN 'hydro' WHEN 'MEDIUM' THEN 'nuclear'
            WHEN 'PROMO' THEN 'solar' WHEN 'SMALL' THEN 'thermal'
            ELSE CASE WHEN p.p_size > 10 THEN 'wind' ELSE 'biomass' END END AS fuel,
          l.l_quantity AS mw, l.l_returnflag AS source, concat('feed/', l.l_linestatus) AS source_url,
          l.l_linestatus = 'O' AS is_provisional, l.l_shipdate + INTERVAL '1' HOUR AS collected_at,
          l.l_shipdate + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
    """,
    "v_frequency": """
        SELECT l_shipdate AS timestamp, CAST(49.9 AS DOUBLE) + l_tax * CAST(2 AS DOUBLE) AS frequency_hz,
          CASE l_returnflag WHEN 'A' THEN 'North' WHEN 'R' THEN 'South' END AS region,
          l_shipdate + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {lineitem}
    """,
    "v_psp": """
        SELECT CAST(o.o_orderdate AS DATE) AS date, r.r_name AS region,
          CASE WHEN n.n_name NOT LIKE '%1' THEN n.n_name END AS state,
          CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice END AS peak_demand_mw,
          CASE o.o_orderstatus WHEN 'F' THEN o.o_totalprice * CAST(0.95 AS DOUBLE)
            WHEN 'O' THEN o.o_totalprice END AS peak_demand_met_mw,
          CASE o.o_orderstatus WHEN 'F' THEN o.o_totalprice * CAST(0.05 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS peak_shortage_mw,
          CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
            ELSE o.o_totalprice / CAST(1000 AS DOUBLE) END AS energy_met_mu,
          CASE o.o_orderstatus WHEN 'F' THEN CAST(2 AS DOUBLE) WHEN 'O' THEN CAST(0 AS DOUBLE) END
            AS energy_shortage_mu,
          CAST(49.8 AS DOUBLE) AS frequency_min_hz,
          CASE WHEN o.o_orderstatus <> 'P' THEN CAST(50.1 AS DOUBLE) END AS frequency_max_hz,
          CAST(50 AS DOUBLE) AS frequency_avg_hz,
          CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.o_orderpriority END AS source_url,
          o.o_orderdate + INTERVAL '1' DAY AS ingestion_timestamp
        FROM {orders} o
        JOIN {customer} c ON o.o_custkey = c.c_custkey
        JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        JOIN {region} r ON n.n_regionkey = r.r_regionkey
    """,
    # Each observation is fetched twice, the second time corrected; some have no source.
    "v_batches": """
        SELECT state, region, timestamp, demand_mw + CAST(batch AS DOUBLE) AS demand_mw, peak_mw,
          frequency_hz, CASE WHEN source <> 'error' THEN source END AS source, source_type,
          rolling_peak_24mo_mw, installed_in_state_mw, allocated_share_mw, batch,
          CASE WHEN batch = 0 THEN ingestion_timestamp ELSE ingestion_timestamp + INTERVAL '1' DAY END
            AS ingestion_timestamp
        FROM (SELECT d.*, {batches} AS batch FROM (<v_demand>) d) b
    """,
}


def _expanded(name: str, dialect: dict[str, str]) -> str:
    text = re.sub(r"<(\w+)>", lambda m: VIEWS[m.group(1)], VIEWS[name])
    return re.sub(r"\{(\w+)\}", lambda m: dialect.get(m.group(1), m.group(0)), text)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    text = _expanded(name, SPARK)
    used = {t: load(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def with_views(*names: str, then: str) -> str:
    """DuckDB query over the named views."""
    ctes = [
        f"{name} AS ({re.sub(r'[{](\w+)[}]', r'\1', _expanded(name, DUCKDB))})" for name in names
    ]
    return f"WITH {', '.join(ctes)} {then}"
