"""The order tables in the roles of the weather-station model.

Suppliers are stations, line items their readings, nations and regions their
areas. Every frame here is a plain projection or join of the whole tables.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.conform import (
    OBSERVATION_FIELDS,
    OBSERVATION_HASH,
    STATION_FIELDS,
    STATION_HASH,
    conform,
)
from tidemark.operators.metrics import to_fact
from tidemark.operators.scd2 import STATION_COLUMNS, scd2_stage
from tidemark.schemas import LANDED_STATION, WEATHER_METRICS

SOURCE = "orders_feed"
DAY_1 = datetime(2024, 1, 1, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 2, 1, tzinfo=timezone.utc)
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


# Columns of the given tables, declared to save reading them off the files.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def station_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed station records: supplier, nation and region."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("station_name"),
            F.col("s_acctbal").alias("latitude"),
            F.col("s_nationkey").cast("double").alias("longitude"),
            F.concat(F.lit(" "), F.lower("r_name")).alias("region"),
            F.concat(F.lit("R"), "r_regionkey").alias("country_code"),
            F.when(F.col("s_acctbal") < 0, " Manual").otherwise("Automatic ").alias("station_type"),
            F.concat(F.lit("S"), "s_suppkey").alias("geohash"),
            F.concat(F.lit(" "), "n_name").alias("area"),
            F.col("r_name").alias("country"),
            F.when(F.col("s_nationkey") > 4, "Etc/UTC").alias("olson_time_zone"),
        )
        .to(LANDED_STATION)
    )


def readings(lineitem: DataFrame, text_time: bool = True) -> DataFrame:
    """Flat landed readings: line items. Zero tax and discount stand for no value."""
    shipped = F.col("l_shipdate")
    moment = F.date_format(shipped, ISO) if text_time else shipped.cast("timestamp")
    return lineitem.select(
        F.concat(F.lit("S"), "l_suppkey").alias("station_geohash"),
        moment.alias("datetime"),
        F.col("l_partkey").alias("visibility"),
        F.nullif("l_tax", F.lit(0.0)).alias("temperature"),
        F.col("l_discount").alias("mslp"),
        F.col("l_extendedprice").alias("wind_gust"),
        F.col("l_returnflag").alias("wind_direction"),
        F.col("l_quantity").alias("wind_speed"),
        F.nullif("l_discount", F.lit(0.0)).alias("humidity"),
        F.col("l_linenumber").cast("long").alias("weather_code"),
        F.col("l_linestatus").alias("pressure_tendency"),
    )


def silver_readings(spark: SparkSession, sf_dir: str, text_time: bool = True) -> DataFrame:
    rows = readings(table(spark, sf_dir, "lineitem"), text_time)
    return conform(rows, OBSERVATION_FIELDS, OBSERVATION_HASH, SOURCE, as_of=DAY_1)


def fact(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Fact rows of all readings: all metrics, or only the named ones, which keeps
    the columns of the others out of the scan."""
    metrics = [m for m in WEATHER_METRICS if not names or m.name in names]
    return to_fact(silver_readings(spark, sf_dir, text_time=False), metrics, SOURCE, as_of=DAY_1)


def silver_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(
        station_records(spark, sf_dir), STATION_FIELDS, STATION_HASH, SOURCE, as_of=DAY_1
    )


def silver_stations_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows of a second feed: suppliers in debt moved, customers are new
    stations, and the suppliers of region 2 were not delivered again."""
    moved = F.when(F.col("latitude") < 0, F.concat("area", F.lit(" (moved)"))).otherwise(
        F.col("area")
    )
    again = station_records(spark, sf_dir).withColumn("area", moved)
    again = again.filter(F.col("country_code") != "R2")
    fresh = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("station_name"),
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
        F.lower("c_mktsegment").alias("region"),
        F.lit("C").alias("country_code"),
        F.lit("Automatic").alias("station_type"),
        F.concat(F.lit("C"), "c_custkey").alias("geohash"),
        F.col("c_mktsegment").alias("area"),
        F.lit("NEW").alias("country"),
        F.lit("Etc/UTC").alias("olson_time_zone"),
    )
    return conform(again.unionByName(fresh), STATION_FIELDS, STATION_HASH, SOURCE, as_of=DAY_2)


def silver_station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after both feeds."""
    return silver_stations(spark, sf_dir).unionByName(silver_stations_again(spark, sf_dir))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension after the first load."""
    return scd2_stage(silver_stations(spark, sf_dir), STATION_COLUMNS, SOURCE, DAY_1)


def dimension_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version per station of the silver history."""
    return scd2_stage(silver_station_history(spark, sf_dir), STATION_COLUMNS, SOURCE, DAY_2)
