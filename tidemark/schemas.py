"""Declared schemas and the field lists of the weather-station model.

Declaring them saves the inference pass over the landed files and keeps a column
from changing its type between batches.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


def _struct(**fields: str) -> T.StructType:
    types = {
        "s": T.StringType(),
        "d": T.DoubleType(),
        "i": T.IntegerType(),
        "l": T.LongType(),
        "b": T.BooleanType(),
        "t": T.TimestampType(),
    }
    return T.StructType([T.StructField(name, types[code]) for name, code in fields.items()])


SEED = _struct(
    station_name="s", region="s", country_code="s", location="s", station_type="s", is_monitored="i"
)

LANDED_STATION = _struct(
    station_name="s",
    latitude="d",
    longitude="d",
    region="s",
    country_code="s",
    station_type="s",
    geohash="s",
    area="s",
    country="s",
    olson_time_zone="s",
)

READING = _struct(
    datetime="s",
    visibility="l",
    temperature="d",
    mslp="d",
    wind_gust="d",
    wind_direction="s",
    wind_speed="d",
    humidity="d",
    weather_code="l",
    pressure_tendency="s",
)


def envelope(reading: T.StructType, key: str = "station_geohash") -> T.StructType:
    """Schema of a landed envelope around ``reading``; ``data`` must be an array."""
    return T.StructType(
        [
            T.StructField(key, T.StringType()),
            T.StructField("extracted_at", T.StringType()),
            T.StructField("data", T.ArrayType(reading)),
        ]
    )


LANDED_OBSERVATION = envelope(READING)

_AUDIT = _struct(_source_file="s", _processed_at="t", _extraction_id="s", _row_hash="s")

BRONZE_STATION = T.StructType(LANDED_STATION.fields + _AUDIT.fields)


def bronze_observation(reading: T.StructType) -> T.StructType:
    """Schema of flattened, audited readings."""
    keys = _struct(station_geohash="s", extracted_at="s")
    return T.StructType(keys.fields + reading.fields + _AUDIT.fields)


BRONZE_OBSERVATION = bronze_observation(READING)

SILVER_STATION = _struct(
    station_name="s",
    station_geohash="s",
    latitude="d",
    longitude="d",
    county_name="s",
    country_name="s",
    country_code="s",
    station_type="s",
    olson_time_zone="s",
    region_code="s",
    _processed_at="t",
    _row_hash="s",
    _source_system="s",
)

SILVER_OBSERVATION = _struct(
    station_geohash="s",
    observation_datetime="s",
    visibility_m="l",
    temperature_c="d",
    mean_sea_level_pressure_hpa="d",
    wind_gust_ms="d",
    wind_direction="s",
    wind_speed_ms="d",
    humidity_percentage="d",
    weather_code="l",
    pressure_tendency="s",
    _processed_at="t",
    _row_hash="s",
    _source_system="s",
)

DIM_STATION = _struct(
    StationKey="s",
    StationName="s",
    Latitude="d",
    Longitude="d",
    County="s",
    Country="s",
    CountryCode="s",
    StationType="s",
    RegionCode="s",
    TimeZone="s",
    EffStartDate="t",
    EffEndDate="t",
    IsCurrent="b",
    RowHash="s",
    SourceSystem="s",
)

FACT = _struct(
    StationKey="s",
    DateKey="i",
    ObservationTime="s",
    MetricName="s",
    Unit="s",
    ValueNumeric="d",
    ValueString="s",
    ProcessedAt="t",
    RowHash="s",
    SourceSystem="s",
)


class Metric(NamedTuple):
    """One measured quantity: its name in the fact, source column and unit."""

    name: str
    column: str
    unit: str


# Metric names, columns and units of the fact.
WEATHER_METRICS = (
    Metric("Visibility", "visibility_m", "m"),
    Metric("Temperature", "temperature_c", "C"),
    Metric("Pressure", "mean_sea_level_pressure_hpa", "hPa"),
    Metric("Wind Gust", "wind_gust_ms", "m/s"),
    Metric("Wind Direction", "wind_direction", "text"),
    Metric("Wind Speed", "wind_speed_ms", "m/s"),
    Metric("Humidity", "humidity_percentage", "%"),
    Metric("Weather Code", "weather_code", "code"),
)
