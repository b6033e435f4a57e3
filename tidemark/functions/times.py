"""Day keys and clock times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(moment: str | Column) -> Column:
    """A timestamp from text or time columns; unreadable text is null."""
    return (F.col(moment) if isinstance(moment, str) else moment).try_cast("timestamp")


def date_key(moment: str | Column) -> Column:
    """``yyyyMMdd`` as an int. Plain arithmetic stays in generated code."""
    ts = as_timestamp(moment)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_text(moment: str | Column) -> Column:
    """``yyyy-MM`` of a moment written as text; null where it is empty."""
    text = F.col(moment) if isinstance(moment, str) else moment
    return F.nullif(F.substring(text, 1, 7), F.lit(""))


def clock_text(moment: str | Column) -> Column:
    """``HH:mm:ss`` of a moment."""
    return F.date_format(as_timestamp(moment), "HH:mm:ss")


def wall_time_text(moment: str | Column, zone: str) -> Column:
    """ISO text of a UTC moment as clocks in ``zone`` show it, with that zone's offset."""
    ts = as_timestamp(moment)
    local = F.from_utc_timestamp(ts, zone)
    minutes = ((F.unix_timestamp(local) - F.unix_timestamp(ts)) / 60).cast("int")
    offset = F.when(minutes == 0, F.lit("Z")).otherwise(
        F.format_string(
            "%s%02d:%02d",
            F.when(minutes < 0, "-").otherwise("+"),
            F.floor(F.abs(minutes) / 60).cast("int"),
            F.abs(minutes) % 60,
        )
    )
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset)
