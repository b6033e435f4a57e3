"""Bronze to silver: trim, rename, cast, hash and tag."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import row_hash
from tidemark.operators.bronze import moment


class Field(NamedTuple):
    """One silver column: its bronze source and what is done to it."""

    source: str
    target: str
    trim: bool = False
    upper: bool = False
    cast: str | None = None

    def column(self) -> Column:
        c = F.col(self.source)
        if self.trim:
            c = F.trim(c)
        if self.upper:
            c = F.upper(c)
        if self.cast:
            c = c.try_cast(self.cast)
        return c.alias(self.target)


# Silver columns of the two weather-station feeds.
STATION_FIELDS = (
    Field("station_name", "station_name", trim=True),
    Field("geohash", "station_geohash", trim=True),
    Field("latitude", "latitude", cast="double"),
    Field("longitude", "longitude", cast="double"),
    Field("area", "county_name", trim=True),
    Field("country", "country_name", trim=True),
    Field("country_code", "country_code", trim=True),
    Field("station_type", "station_type", trim=True),
    Field("olson_time_zone", "olson_time_zone", trim=True),
    Field("region", "region_code", trim=True, upper=True),
)
STATION_HASH = ("station_name", "geohash", "area", "country", "olson_time_zone", "region")

OBSERVATION_FIELDS = (
    Field("station_geohash", "station_geohash", trim=True),
    Field("datetime", "observation_datetime"),
    Field("visibility", "visibility_m"),
    Field("temperature", "temperature_c"),
    Field("mslp", "mean_sea_level_pressure_hpa"),
    Field("wind_gust", "wind_gust_ms"),
    Field("wind_direction", "wind_direction"),
    Field("wind_speed", "wind_speed_ms"),
    Field("humidity", "humidity_percentage"),
    Field("weather_code", "weather_code"),
    Field("pressure_tendency", "pressure_tendency"),
)
OBSERVATION_HASH = tuple(f.source for f in OBSERVATION_FIELDS)


def conform(
    df: DataFrame,
    fields: Sequence[Field],
    hash_columns: Sequence[str],
    source_system: str,
    as_of: datetime | Column | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """Silver form of ``df``. The hash covers the raw, unconformed source columns."""
    return df.select(
        *[f.column() for f in fields],
        moment(as_of).alias("_processed_at"),
        row_hash(hash_columns, null_token).alias("_row_hash"),
        F.lit(source_system).alias("_source_system"),
    )
