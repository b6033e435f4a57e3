"""The same questions in SQL, for a side-by-side check on the same tables."""

from __future__ import annotations

_STATION_RAW = """
  SELECT '  ' || s_name || ' ' AS station_name, s_acctbal AS latitude,
         CAST(s_nationkey AS DOUBLE) AS longitude, ' ' || lower(r_name) AS region,
         'R' || r_regionkey AS country_code,
         CASE WHEN s_acctbal < 0 THEN ' Manual' ELSE 'Automatic ' END AS station_type,
         'S' || s_suppkey AS geohash, ' ' || n_name AS area, r_name AS country,
         CASE WHEN s_nationkey > 4 THEN 'Etc/UTC' END AS olson_time_zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
"""

_STATION_AGAIN = """
  SELECT station_name, latitude, longitude, region, country_code, station_type, geohash,
         CASE WHEN latitude < 0 THEN area || ' (moved)' ELSE area END AS area,
         country, olson_time_zone
  FROM station_raw WHERE country_code <> 'R2'
  UNION ALL
  SELECT c_name, c_acctbal, CAST(c_nationkey AS DOUBLE), lower(c_mktsegment), 'C', 'Automatic',
         'C' || c_custkey, c_mktsegment, 'NEW', 'Etc/UTC'
  FROM customer
"""


def _silver_station(raw: str, stamp: str) -> str:
    return f"""
  SELECT trim(station_name) AS station_name, trim(geohash) AS station_geohash,
         latitude, longitude, trim(area) AS county_name, trim(country) AS country_name,
         trim(country_code) AS country_code, trim(station_type) AS station_type,
         trim(olson_time_zone) AS olson_time_zone, upper(trim(region)) AS region_code,
         TIMESTAMP '{stamp}' AS _processed_at,
         sha256(concat_ws('||', station_name, geohash, area, country, olson_time_zone, region))
           AS _row_hash,
         'orders_feed' AS _source_system
  FROM {raw}
"""


def _version(silver: str, stamp: str) -> str:
    return f"""
  SELECT station_geohash AS "StationKey", station_name AS "StationName", latitude AS "Latitude",
         longitude AS "Longitude", county_name AS "County", country_name AS "Country",
         country_code AS "CountryCode", station_type AS "StationType",
         region_code AS "RegionCode", olson_time_zone AS "TimeZone",
         TIMESTAMP '{stamp}' AS "EffStartDate", CAST(NULL AS TIMESTAMP) AS "EffEndDate",
         true AS "IsCurrent", _row_hash AS "RowHash", 'orders_feed' AS "SourceSystem"
  FROM {silver}
"""


_DAY_1, _DAY_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"

_STATIONS = f"""WITH station_raw AS ({_STATION_RAW}),
station_again AS ({_STATION_AGAIN}),
silver_1 AS ({_silver_station("station_raw", _DAY_1)}),
silver_2 AS ({_silver_station("station_again", _DAY_2)}),
history AS (SELECT * FROM silver_1 UNION ALL SELECT * FROM silver_2),
newest AS (
  SELECT * FROM history
  QUALIFY row_number() OVER (PARTITION BY station_geohash ORDER BY _processed_at DESC) = 1),
dim AS ({_version("silver_1", _DAY_1)}),
updates AS ({_version("newest", _DAY_2)}),
changes AS (
  SELECT u.* FROM updates u LEFT JOIN dim d ON u."StationKey" = d."StationKey"
  WHERE d."StationKey" IS NULL OR u."RowHash" IS DISTINCT FROM d."RowHash"),
next_dim AS (
  SELECT d.* REPLACE (
    CASE WHEN c."StationKey" IS NULL THEN d."EffEndDate" ELSE TIMESTAMP '{_DAY_2}' END
      AS "EffEndDate",
    c."StationKey" IS NULL AS "IsCurrent")
  FROM dim d LEFT JOIN changes c ON d."StationKey" = c."StationKey"
  UNION ALL SELECT * FROM changes)
"""

_READINGS = """
  SELECT 'S' || l_suppkey AS station_geohash,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime, l_partkey AS visibility,
         nullif(l_tax, 0.0) AS temperature, l_discount AS mslp, l_extendedprice AS wind_gust,
         l_returnflag AS wind_direction, l_quantity AS wind_speed,
         nullif(l_discount, 0.0) AS humidity, CAST(l_linenumber AS BIGINT) AS weather_code,
         l_linestatus AS pressure_tendency
  FROM lineitem
"""

_SEASON = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'Winter' WHEN month({0}) IN (3, 4, 5) THEN 'Spring'
       WHEN month({0}) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""

_METRICS = (
    ("Visibility", "visibility", "m", True),
    ("Temperature", "temperature", "C", True),
    ("Pressure", "mslp", "hPa", True),
    ("Wind Gust", "wind_gust", "m/s", True),
    ("Wind Direction", "wind_direction", "text", False),
    ("Wind Speed", "wind_speed", "m/s", True),
    ("Humidity", "humidity", "%", True),
    ("Weather Code", "weather_code", "code", True),
)


def _day_key(moment: str) -> str:
    return f"CAST(strftime({moment}, '%Y%m%d') AS INTEGER)"


def _fact(source: str = "readings") -> str:
    """Long form of the readings: one branch per metric."""
    key = _day_key("CAST(replace(datetime, 'Z', '') AS TIMESTAMP)")
    return " UNION ALL ".join(
        f"""
  SELECT station_geohash AS "StationKey", {key} AS "DateKey", substr(datetime, 12, 8) AS "ObservationTime",
         '{name}' AS "MetricName", '{unit}' AS "Unit", CAST({column} AS VARCHAR) AS "RawValue",
         {f"CAST({column} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"} AS "ValueNumeric",
         {"CAST(NULL AS VARCHAR)" if number else column} AS "ValueString"
  FROM {source}"""
        for name, column, unit, number in _METRICS
    )


_HASH = """sha256(concat_ws('||', "StationKey", "DateKey", "MetricName"))"""

_FACT = f"WITH readings AS ({_READINGS}), fact AS ({_fact()})\n"


def _calendar(low: str, high: str) -> str:
    return f"""
  SELECT {_day_key("d")} AS "DateKey", CAST(d AS DATE) AS "FullDate", CAST(year(d) AS INTEGER) AS "Year",
         CAST(month(d) AS INTEGER) AS "Month", CAST(day(d) AS INTEGER) AS "Day",
         monthname(d) AS "MonthName", dayname(d) AS "DayName",
         CAST(quarter(d) AS INTEGER) AS "Quarter", dayofweek(d) IN (0, 6) AS "IsWeekend",
         {_SEASON.format("d")} AS "Season", 'generated_calendar' AS "SourceSystem"
  FROM (SELECT unnest(generate_series({low}, {high}, INTERVAL 1 DAY)) AS d)
"""


_SHIP_CALENDAR = _calendar(
    "(SELECT min(l_shipdate) FROM lineitem)", "(SELECT max(l_shipdate) FROM lineitem)"
)

_EVENT_FACT = f"""
  SELECT CAST(user_id AS VARCHAR) AS "StationKey", {_day_key("ts")} AS "DateKey",
         strftime(ts, '%H:%M:%S') AS "ObservationTime", 'Value' AS "MetricName", 'n' AS "Unit",
         value AS "ValueNumeric", CAST(NULL AS VARCHAR) AS "ValueString"
  FROM events
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), {_day_key("ts")}, strftime(ts, '%H:%M:%S'), 'Type', 'text',
         CAST(NULL AS DOUBLE), event_type
  FROM events
"""

_LEADERBOARD = f"""
WITH scores AS (
  SELECT {_SEASON.format("l_shipdate")} AS "Season", l_suppkey,
         round(avg(l_quantity), 4) AS "AverageValue", max(l_extendedprice) AS "PeakValue"
  FROM lineitem GROUP BY ALL)
SELECT "Season", 'S' || l_suppkey AS "StationKey", s_name AS "StationName", "AverageValue", "PeakValue",
       rank() OVER (PARTITION BY "Season" ORDER BY "AverageValue" DESC NULLS LAST) AS "Rank",
       rank() OVER (PARTITION BY "Season" ORDER BY "PeakValue" DESC NULLS LAST) AS "PeakRank"
FROM scores JOIN supplier ON l_suppkey = s_suppkey"""

ORACLE: dict[str, str] = {
    "season_leaderboard": _LEADERBOARD,
    "season_leaderboard_sliced": _LEADERBOARD,
    "dim_date_range": _calendar(
        "(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
        "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)",
    ),
    "landed_batches_all": """
SELECT DISTINCT 'S' || l_suppkey AS station_geohash, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime
FROM lineitem""",
    "landed_again": f"""
WITH readings AS ({_READINGS}),
batches AS (
  SELECT *, CASE wind_direction WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS landed FROM readings)
SELECT station_geohash, datetime, wind_direction FROM batches
QUALIFY row_number() OVER (PARTITION BY station_geohash, datetime ORDER BY landed) = 1""",
    "bronze_stream": f"""
WITH readings AS ({_READINGS}),
batches AS (
  SELECT *, third, '2024010' || (third + 1) || '_000000+0000' AS extracted_at
  FROM readings, (VALUES (0), (1), (2)) AS t(third)
  WHERE CAST(substr(datetime, 6, 2) AS INTEGER) % 3 IN (third, greatest(third - 1, 0))),
hashed AS (
  SELECT *, sha256(concat_ws('||', station_geohash, extracted_at, datetime, visibility, temperature, mslp,
    wind_gust, wind_direction, wind_speed, humidity, weather_code, pressure_tendency)) AS _row_hash
  FROM batches)
SELECT station_geohash, datetime, extracted_at, visibility, wind_speed, 'run-' || third AS _extraction_id, _row_hash
FROM hashed
QUALIFY row_number() OVER (PARTITION BY station_geohash, datetime ORDER BY third, _row_hash) = 1""",
    "bronze_late_month": """
SELECT strftime(l_shipdate, '%Y-%m') AS load_month, count(DISTINCT (l_suppkey, l_shipdate)) AS readings,
       count(DISTINCT l_suppkey) AS stations
FROM lineitem GROUP BY ALL""",
    "dim_station_incremental": f"{_STATIONS} SELECT * FROM next_dim",
    "late_station": """
SELECT DISTINCT 'S' || l_suppkey AS station_geohash, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
       CASE n_regionkey WHEN 2 THEN 'day-2' WHEN 3 THEN 'parked' ELSE 'day-1' END AS run
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "station_ingest": """
SELECT s_name AS station_name, 'N' || s_nationkey AS station_geohash, n_name AS county_name,
       upper('r' || n_regionkey) AS region_code, CAST(s_nationkey || '.001' AS DOUBLE) AS latitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0""",
    "dim_date": _SHIP_CALENDAR,
    "fact_unpivot": f"""{_FACT}
SELECT "StationKey", "DateKey", "MetricName", "RawValue", "Unit", {_HASH} AS "RowHash" FROM fact""",
    "fact_typed_values": f"""
WITH long AS (
  SELECT event_id, ts, unnest(['Value', 'Type', 'Props']) AS "MetricName",
         unnest([CAST(value AS VARCHAR), event_type, props]) AS raw
  FROM events)
SELECT event_id, {_day_key("ts")} AS "DateKey", strftime(ts, '%H:%M:%S') AS "ObservationTime",
       "MetricName", try_cast(raw AS DOUBLE) AS "ValueNumeric",
       CASE WHEN try_cast(raw AS DOUBLE) IS NULL THEN raw END AS "ValueString"
FROM long""",
    "fact_rows": f"""{_FACT}
SELECT "StationKey", "DateKey", "ObservationTime", "MetricName", "Unit", "ValueNumeric", "ValueString",
       TIMESTAMP '{_DAY_1}' AS "ProcessedAt", {_HASH} AS "RowHash", 'orders_feed' AS "SourceSystem"
FROM fact""",
    "metric_breakdown": f"""{_FACT}
SELECT "MetricName", count(*) AS "RowCount", count("ValueNumeric") AS "NumericCount",
       count("ValueString") AS "StringCount"
FROM fact GROUP BY "MetricName\"""",
    "eav_pivot": f"""
SELECT 'S' || l_suppkey AS "StationKey", {_day_key("l_shipdate")} AS "DateKey",
       strftime(l_shipdate, '%H:%M:%S') AS "ObservationTime", max(l_quantity) AS wind_speed,
       max(l_extendedprice) AS wind_gust, max(nullif(l_tax, 0.0)) AS temperature,
       max(l_returnflag) AS wind_direction, CAST(max(l_partkey) AS DOUBLE) AS visibility,
       max(l_discount) AS pressure, max(nullif(l_discount, 0.0)) AS humidity,
       CAST(max(l_linenumber) AS DOUBLE) AS weather_code
FROM lineitem GROUP BY ALL""",
    "fact_orphans": f"""{_FACT}
SELECT 'StationKey' AS "Relation", "StationKey" AS "KeyValue", count(*) AS "FactRows" FROM fact
WHERE "StationKey" NOT IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal >= 0)
GROUP BY "StationKey"
UNION ALL
SELECT 'DateKey', CAST("DateKey" AS VARCHAR), count(*) FROM fact
WHERE "DateKey" < (SELECT min({_day_key("o_orderdate")}) FROM orders)
   OR "DateKey" > (SELECT max({_day_key("o_orderdate")}) FROM orders)
GROUP BY "DateKey\"""",
    "duplicate_current": f"""{_STATIONS}
SELECT station_geohash AS "StationKey", count(*) AS "Versions" FROM history
GROUP BY station_geohash HAVING count(*) > 1""",
    "silver_conform_stations": f"{_STATIONS} SELECT * FROM silver_1",
    "silver_conform_observations": f"""WITH readings AS ({_READINGS})
SELECT trim(station_geohash) AS station_geohash, datetime AS observation_datetime,
       visibility AS visibility_m, temperature AS temperature_c, mslp AS mean_sea_level_pressure_hpa,
       wind_gust AS wind_gust_ms, wind_direction, wind_speed AS wind_speed_ms,
       humidity AS humidity_percentage, weather_code, pressure_tendency,
       TIMESTAMP '{_DAY_1}' AS _processed_at,
       sha256(concat_ws('||', station_geohash, datetime, visibility, temperature, mslp, wind_gust,
         wind_direction, wind_speed, humidity, weather_code, pressure_tendency)) AS _row_hash,
       'orders_feed' AS _source_system
FROM readings""",
    "bronze_audit_hash": f"""
WITH o AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
  FROM orders)
SELECT *, 'orders.parquet' AS _source_file, TIMESTAMP '{_DAY_1}' AS _processed_at,
       'run-1' AS _extraction_id,
       sha256(concat_ws('||', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate))
         AS _row_hash
FROM o""",
    "name_from_file": """
WITH t AS (
  SELECT s_suppkey, s_name || ': ' || n_name || ', (land)' AS title
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT regexp_replace(title, '[^A-Za-z0-9._-]', '_', 'g') AS station_name, s_suppkey, title FROM t""",
    "bronze_incremental": """
WITH o AS (
  SELECT * REPLACE (CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey)
  FROM orders),
earlier AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01'),
fresh AS (
  SELECT * FROM o AS b
  WHERE NOT EXISTS (
    SELECT 1 FROM earlier e
    WHERE e.o_custkey IS NOT DISTINCT FROM b.o_custkey AND e.o_orderdate = b.o_orderdate)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1)
SELECT * FROM earlier UNION ALL SELECT * FROM fresh""",
    "bronze_schema_evolution": """
SELECT * EXCLUDE (p_retailprice, p_size) FROM part UNION ALL BY NAME SELECT * FROM part""",
    "seed_stations": """
WITH s AS (
  SELECT s_name || ', "main"' AS station_name, 'Region ' || s_nationkey AS region, s_nationkey AS n,
         s_nationkey || '.' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS lat,
         '-' || (s_suppkey % 180) || '.5' AS lon
  FROM supplier WHERE s_acctbal >= 0),
t AS (
  SELECT *, CASE n WHEN 3 THEN 'unknown' WHEN 4 THEN lat WHEN 5 THEN lat || ', east'
                   WHEN 6 THEN lat || 'd, 1.5' ELSE lat || ', ' || lon END AS location
  FROM s)
SELECT station_name, region, 'GB' AS country_code, location, 'Automatic' AS station_type,
       1 AS is_monitored, CASE WHEN n NOT IN (3, 6) THEN CAST(lat AS DOUBLE) END AS latitude,
       CASE WHEN n = 6 THEN 1.5 WHEN n NOT IN (3, 4, 5) THEN CAST(lon AS DOUBLE) END AS longitude
FROM t""",
    "metadata_override_merge": """
SELECT s_name AS station_name,
       coalesce(CASE WHEN n_regionkey > 0 THEN 'R' || n_regionkey END, 'seed region') AS region,
       'GB' AS country_code, 'N' || n_nationkey AS geohash, n_name AS area
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0""",
    "station_drive_list": "SELECT DISTINCT 'S' || l_suppkey AS station_geohash FROM lineitem",
    "landed_roundtrip_explode": f"""
SELECT station_geohash, '20240101_000000+0000' AS extracted_at, * EXCLUDE (station_geohash)
FROM ({_READINGS})""",
    "landed_multiline_scan": """
SELECT 'C' || o_custkey AS station_geohash, '20240101_000000+0000' AS extracted_at,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime, o_totalprice AS temperature,
       o_orderkey AS visibility, o_orderpriority AS wind_direction
FROM orders""",
    "latest_batch_scan": """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate,
       '20240331_013000+0000' AS version
FROM orders WHERE o_orderstatus = 'O'""",
    "dim_station_initial": f"{_STATIONS} SELECT * FROM dim",
    "scd2_changes": f"{_STATIONS} SELECT * FROM changes",
    "scd2_apply": f"{_STATIONS} SELECT * FROM next_dim",
    "scd2_idempotent": f"{_STATIONS} SELECT * FROM next_dim",
    "scd2_current": f"""{_STATIONS}
SELECT "StationKey", "StationName", "County", "EffStartDate" FROM next_dim WHERE "IsCurrent\"""",
    "scd2_point_in_time": f"""{_STATIONS},
versions AS (
  SELECT "StationKey", "StationName", "County",
         CASE WHEN "EffStartDate" = TIMESTAMP '{_DAY_2}' THEN TIMESTAMP '1998-01-01'
              ELSE TIMESTAMP '{_DAY_1}' - INTERVAL 9999 DAY END AS "EffStartDate",
         row_number() OVER (PARTITION BY "StationKey" ORDER BY "EffStartDate") = 1 AS is_first,
         CASE WHEN "EffEndDate" IS NOT NULL THEN TIMESTAMP '1998-01-01' END AS "EffEndDate"
  FROM next_dim)
SELECT l_orderkey, l_linenumber, "StationKey", l_quantity, l_shipdate,
       "StationName", "County", "EffStartDate", "EffEndDate"
FROM lineitem JOIN versions ON 'S' || l_suppkey = "StationKey"
 AND (is_first OR l_shipdate >= "EffStartDate") AND ("EffEndDate" IS NULL OR l_shipdate < "EffEndDate")""",
    "scd2_point_in_time_dense": """
SELECT l_orderkey, l_linenumber, 'S' || l_suppkey AS "StationKey", l_shipdate,
       'S' || l_suppkey || '@' || strftime(l_shipdate, '%Y-%m') AS "VersionKey"
FROM lineitem""",
    "silver_stream_append": f"""
SELECT event_id, upper(trim(event_type)) AS event_code, value, ts AS event_time,
       TIMESTAMP '{_DAY_1}' AS _processed_at, sha256(concat_ws('||', event_id, event_type)) AS _row_hash,
       'orders_feed' AS _source_system
FROM events""",
    "fact_stream_foreachbatch": f"""
WITH f AS ({_EVENT_FACT})
SELECT f.*, TIMESTAMP '{_DAY_1}' AS "ProcessedAt", {_HASH} AS "RowHash",
       'orders_feed' AS "SourceSystem", sink AS "Sink"
FROM f, (VALUES ('gold'), ('copy'), ('replayed')) AS s(sink)""",
    "publish_refresh": _SHIP_CALENDAR,
    "publish_versions": _SHIP_CALENDAR,
    "season_leaderboard_folded": _LEADERBOARD,
    "connector_append_once": f"""
WITH f AS ({_EVENT_FACT})
SELECT f.*, TIMESTAMP '{_DAY_1}' AS "ProcessedAt", {_HASH} AS "RowHash", 'orders_feed' AS "SourceSystem",
       CASE WHEN "DateKey" >= 20240120 THEN 'q-1' ELSE 'q-0' END AS batch_id
FROM f""",
    "layered_full_run": f"""
WITH readings AS ({_READINGS}),
kept AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (
    PARTITION BY station_geohash, datetime
    ORDER BY sha256(concat_ws('||', station_geohash, '20240101_000000+0000', datetime, visibility,
      temperature, mslp, wind_gust, wind_direction, wind_speed, humidity, weather_code,
      pressure_tendency))) = 1),
fact AS ({_fact("kept")})
SELECT n_name AS "County", "MetricName", count(*) AS "RowCount", count("ValueNumeric") AS "NumericCount",
       count("ValueString") AS "StringCount",
       CAST(sum(CAST("ValueNumeric" AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS "Total"
FROM fact JOIN supplier ON "StationKey" = 'S' || s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL""",
}
