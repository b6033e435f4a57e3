"""Keeping only what is new, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = "_key"


def key_struct(keys: Sequence[str]) -> Column:
    """The keys as one struct. Structs compare field by field with null equal to
    null, and joins, windows and distinct on it share one shuffle."""
    return F.struct(*keys).alias(_KEY)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (), keep_key: bool = False
) -> DataFrame:
    """The first row of each key in ``order``; equal rows are settled by content.

    Spark keeps only the leading row per key and task before the shuffle, so a
    key with a large share of all rows costs no more than any other. With
    ``keep_key`` the key struct stays, for a join that reuses the shuffle.
    """
    content = F.xxhash64(*df.columns)
    ranked = Window.partitionBy(_KEY).orderBy(*order, content)
    first = (
        df.withColumn(_KEY, key_struct(keys))
        .withColumn("_n", F.row_number().over(ranked))
        .filter(F.col("_n") == 1)
        .drop("_n")
    )
    return first if keep_key else first.drop(_KEY)


def latest_per_key(df: DataFrame, keys: Sequence[str], moment: str) -> DataFrame:
    """The newest row of each key."""
    return first_per_key(df, keys, [F.col(moment).desc_nulls_last()])


def value_range(df: DataFrame, column: str) -> tuple[Column, Column] | None:
    """Smallest and largest value as literals, or None where there is no value.

    Instants travel as microseconds and wall times as text: Python's datetime is
    ambiguous in the hour that clocks are set back, and read in the host's zone.
    """
    kind = df.schema[column].dataType
    low, high = F.min(column), F.max(column)
    if isinstance(kind, T.TimestampType):
        low, high, wrap = F.unix_micros(low), F.unix_micros(high), F.timestamp_micros
    elif isinstance(kind, T.TimestampNTZType):
        low, high, wrap = low.cast("string"), high.cast("string"), lambda c: c.cast(kind)
    else:
        wrap = lambda c: c
    bounds = df.agg(low, high).first()
    return None if bounds[0] is None else (wrap(F.lit(bounds[0])), wrap(F.lit(bounds[1])))


#: Beyond so many values of a part the range of them is looked through instead.
MOST_PARTS = 1000


def in_parts_of(df: DataFrame, part: Column, stored_part: str) -> Column:
    """Condition on ``stored_part``: that it is one of the values ``part`` has in ``df``.

    The values are found first, a partial distinct of a narrow column, and stand in the
    condition as literals, so that a scan of folders by that column skips the others.
    """
    rows = df.select(part.alias("p")).distinct().limit(MOST_PARTS + 1).collect()
    values = [row.p for row in rows if row.p is not None]
    if len(rows) > MOST_PARTS:
        range_ = value_range(df.select(part.alias("p")), "p")
        return F.col(stored_part).between(*range_) | F.col(stored_part).isNull()
    inside = F.col(stored_part).isin(values) if values else F.lit(False)
    return inside | F.col(stored_part).isNull() if len(values) < len(rows) else inside


#: Rows of a part that one task sorts and writes; and the cells by which it is seen whether
#: the keys of a part can be dealt out evenly.
DEALT_ROWS, CELLS = 250_000, 64


def new_in_shares(
    df: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[Column | str],
    part: Column,
    part_name: str,
) -> DataFrame | None:
    """What ``only_new`` gives, with ``part`` (an expression of keys) as column ``part_name``
    and dealt out by it in shares of some ``DEALT_ROWS``, ready to be written in folders.

    Rows and the stored keys of the same parts are moved once, together, and ``order`` is worked
    out where they arrive. None where that would not do: a key, or few, with most rows of a
    part, or too many parts. ``df`` is read twice and should be a written table.
    """
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS))
    cells = df.groupBy(part.alias("part"), cell.alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    parts = cells.groupBy("part").agg(F.sum("rows").alias("rows"), F.max("rows").alias("most"))
    found = parts.limit(MOST_PARTS + 1).collect()
    uneven = any(row.most > max(DEALT_ROWS, 4 * row.rows / CELLS) for row in found)
    if uneven or len(found) > MOST_PARTS:
        return None
    shares = {row.part: -(-row.rows // DEALT_ROWS) for row in found}
    many = {value: n for value, n in shares.items() if n > 1 and value is not None}
    of_part = F.lit(shares.get(None, 1))
    if many:
        of_part = F.coalesce(F.create_map(*[F.lit(x) for pair in many.items() for x in pair])[F.col(part_name)], of_part)
    rows = df.withColumn(part_name, part).withColumn("_stored", F.lit(False))
    if existing is not None:
        values = [value for value in shares if value is not None]
        inside = F.col(part_name).isin(values) if values else F.lit(False)
        if None in shares:
            inside = inside | F.col(part_name).isNull()
        stored = existing.filter(inside).select(*keys, part_name, F.lit(True).alias("_stored"))
        rows = rows.unionByName(stored, allowMissingColumns=True)
    share = F.pmod(F.xxhash64(*keys), of_part).cast("int")
    spark = df.sparkSession
    tasks = []
    if sum(row.rows for row in found) > DEALT_ROWS * spark.sparkContext.defaultParallelism:
        # a number keeps small partitions from being put together by their packed size: such a
        # task would sort many shares at once, on disk where they do not fit into memory
        tasks = [max(sum(shares.values()), int(spark.conf.get("spark.sql.shuffle.partitions")))]
    dealt = rows.withColumn("_share", share).repartition(*tasks, part_name, "_share")
    first = Window.partitionBy(part_name, "_share", *keys).orderBy(F.col("_stored").desc(), *order)
    return (
        dealt.withColumn("_n", F.row_number().over(first))
        .filter((F.col("_n") == 1) & ~F.col("_stored"))
        .drop("_n", "_stored", "_share")
    )


def only_new(
    df: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    dedup: bool = True,
    prune_on: str | None = None,
    prune_parts: tuple[Column, str] | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is not stored yet, nulls counting as equal.

    Within the batch one row per key is kept (the first in ``order``) unless
    ``dedup`` is off. Both sides reach the join with distinct keys, so neither
    is skewed. ``prune_on`` names an orderable key column: only stored rows
    within the batch's range of it are scanned. ``prune_parts`` is an expression of key
    columns and the column of ``existing``, a folder level, that holds it: only the folders
    of the batch's own values are scanned, so one late row adds one folder.
    """
    if prune_parts is not None:
        existing = existing.filter(in_parts_of(df, *prune_parts))
    if prune_on is not None:
        column, range_ = F.col(prune_on), value_range(df, prune_on)
        inside = column.between(*range_) if range_ else F.lit(False)
        existing = existing.filter(column.isNull() | inside)
    if dedup:
        batch = first_per_key(df, keys, order, keep_key=True)
    else:
        batch = df.withColumn(_KEY, key_struct(keys))
    stored = existing.select(key_struct(keys)).distinct()
    return batch.join(stored, _KEY, "left_anti").drop(_KEY)
