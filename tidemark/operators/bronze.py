"""Landed to bronze: flatten, audit, order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import row_hash, wall_time_text


def flatten(df: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element with the element's fields as columns.

    Null and empty arrays give no row.
    """
    return df.select(*keep, F.inline(array))


def moment(as_of: datetime | Column | None) -> Column:
    """A processing time: the given one, or the query's start.

    A datetime must carry its offset; without one it would be read in the host's zone.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        raise ValueError("a processing time needs an offset")
    return F.lit(as_of).cast("timestamp")


def with_audit(
    df: DataFrame,
    run_id: str,
    as_of: datetime | Column | None = None,
    source_file: str | Column = "_source_file",
    hash_columns: Sequence[str] | None = None,
    null_token: str | None = None,
    stamp_zone: str | None = None,
) -> DataFrame:
    """Add source file, processing time, run id and a hash over the source columns.

    The processing time is a timestamp; ``stamp_zone`` makes it the ISO text of
    that zone's wall time instead.
    """
    content = [c for c in df.columns if not c.startswith("_")]
    stamp = moment(as_of)
    return df.select(
        *content,
        (F.col(source_file) if isinstance(source_file, str) else source_file).alias("_source_file"),
        (wall_time_text(stamp, stamp_zone) if stamp_zone else stamp).alias("_processed_at"),
        F.lit(run_id).alias("_extraction_id"),
        row_hash(hash_columns or content, null_token).alias("_row_hash"),
    )


def columns_first(df: DataFrame, *names: str) -> DataFrame:
    """The same columns with ``names`` in front."""
    return df.select(*names, *[c for c in df.columns if c not in names])
