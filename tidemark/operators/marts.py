"""Questions asked of the star schema."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.incremental import key_struct
from tidemark.operators.ranking import TASK_ROWS, rank_desc
from tidemark.operators.scd2 import current_versions
from tidemark.sources.tables import staged


# The metric averaged by the season leaderboard, and the one whose peaks it shows.
SEASON_METRICS = ("Wind Speed", "Wind Gust")


def metric_breakdown(fact: DataFrame) -> DataFrame:
    """Rows per metric, split into number and text values."""
    return fact.groupBy("MetricName").agg(
        F.count(F.lit(1)).alias("RowCount"),
        F.count("ValueNumeric").alias("NumericCount"),
        F.count("ValueString").alias("StringCount"),
    )


def eav_pivot(
    fact: DataFrame,
    metrics: Mapping[str, str],
    text_metrics: Collection[str] = (),
    keys: Sequence[str] = ("StationKey", "DateKey", "ObservationTime"),
) -> DataFrame:
    """Wide view: one row per ``keys``, one column per entry of ``metrics``.

    ``metrics`` maps metric names to column names. Being given, they need no pass
    to find them, and conditional aggregation does the turn. Numbers and texts are turned
    apart, each reading its own metrics only: a maximum of numbers is kept in a hash table,
    one of texts needs its rows sorted. Both are dealt out by the same key, so that putting
    them together moves nothing.
    """
    numbers = {m: alias for m, alias in metrics.items() if m not in text_metrics}
    texts = {m: alias for m, alias in metrics.items() if m in text_metrics}

    def turned(some: Mapping[str, str], value: str) -> DataFrame:
        cells = [F.max(F.when(F.col("MetricName") == m, F.col(value))).alias(alias) for m, alias in some.items()]
        return fact.filter(F.col("MetricName").isin(*some)).groupBy(key_struct(keys)).agg(*cells)

    parts = [turned(some, value) for some, value in ((numbers, "ValueNumeric"), (texts, "ValueString")) if some]
    wide = parts[0] if len(parts) == 1 else parts[0].join(parts[1], "_key", "full")
    return wide.select(*[F.col(f"_key.{k}").alias(k) for k in keys], *metrics.values())


def season_parts(
    fact: DataFrame, calendar: DataFrame, average_of: str = SEASON_METRICS[0], peak_of: str = SEASON_METRICS[1]
) -> DataFrame:
    """What the season leaderboard needs of some fact rows, per station and season: the sum
    and the number of one metric's values, the maximum of the other's.

    Parts of any division of the fact add up to those of the whole: sums are decimals, which
    do not depend on the order of addition. What no decimal holds (no number, beyond all
    measures) is summed apart.
    """
    metric, value = F.col("MetricName"), F.col("ValueNumeric")
    averaged = F.when(metric == average_of, value)
    exact = averaged.try_cast("decimal(28,8)")
    return (
        fact.filter(metric.isin(average_of, peak_of))
        .select("StationKey", "DateKey", "MetricName", "ValueNumeric")
        .join(calendar.select("DateKey", "Season"), "DateKey")
        .groupBy("StationKey", "Season")
        .agg(
            F.sum(exact).alias("ValueSum"),
            F.sum(F.when(exact.isNull(), averaged)).alias("OtherSum"),
            F.count(averaged).alias("ValueCount"),
            F.max(F.when(metric == peak_of, value)).alias("PeakValue"),
        )
    )


def season_leaderboard_of(
    parts: DataFrame, stations: DataFrame, digits: int = 4, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Stations ranked per season by their average (``Rank``) and by their peak (``PeakRank``),
    from parts, any number per station and season.

    Averages are rounded to ``digits`` before they are ranked. The folded rows are written
    once and counted for the ranks.
    """
    current = current_versions(stations).select("StationKey", "StationName")
    whole = F.coalesce(F.sum("ValueSum").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("OtherSum"), F.lit(0.0))
    average = whole / F.sum("ValueCount")
    scores = (
        parts.groupBy("StationKey", "Season")
        .agg(
            F.round(F.when(F.sum("ValueCount") > 0, average), digits).alias("AverageValue"),
            F.max("PeakValue").alias("PeakValue"),
        )
        .join(current, "StationKey")
        .select("Season", "StationKey", "StationName", "AverageValue", "PeakValue")
    )
    scores = staged(scores, "season-scores")
    most = scores.groupBy("Season").count().agg(F.max("count")).first()[0] or 0
    ranked = rank_desc(scores, "Season", "AverageValue", most, task_rows=task_rows)
    return rank_desc(ranked, "Season", "PeakValue", most, "PeakRank", task_rows)


def season_leaderboard(
    fact: DataFrame,
    stations: DataFrame,
    calendar: DataFrame,
    average_of: str = SEASON_METRICS[0],
    peak_of: str = SEASON_METRICS[1],
    digits: int = 4,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Stations ranked per season by their average (``Rank``) and by their peak (``PeakRank``).

    The fact meets only the calendar before it is aggregated, so what is
    shuffled is one partial row per station and season, and the station join
    works on the aggregated rows, which are written once and counted for the ranks.
    """
    parts = season_parts(fact, calendar, average_of, peak_of)
    return season_leaderboard_of(parts, stations, digits, task_rows)


def missing_keys(
    fact: DataFrame, dimension: DataFrame, key: str, rows: Column | None = None
) -> DataFrame:
    """Fact keys without a dimension row, and how many fact rows each has.

    Keys are counted first, so the join sees each key once. ``rows`` says how many fact
    rows a row of an aggregated ``fact`` stands for.
    """
    counted = fact.groupBy(key).agg(F.sum(F.lit(1) if rows is None else rows).alias("FactRows"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti").select(
        F.lit(key).alias("Relation"), F.col(key).cast("string").alias("KeyValue"), "FactRows"
    )


def fact_orphans(fact: DataFrame, stations: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact keys that break a relation to the station or the calendar dimension.

    The fact is read once, down to its pairs of keys.
    """
    pairs = staged(
        fact.groupBy("StationKey", "DateKey").agg(F.count(F.lit(1)).alias("_rows")), "fact-keys"
    )
    return missing_keys(pairs, stations, "StationKey", F.col("_rows")).unionByName(
        missing_keys(pairs, calendar, "DateKey", F.col("_rows"))
    )


def duplicate_current(dimension: DataFrame, key: str = "StationKey") -> DataFrame:
    """Keys with more than one current version; these would fan out a join."""
    counted = current_versions(dimension).groupBy(key).agg(F.count(F.lit(1)).alias("Versions"))
    return counted.filter(F.col("Versions") > 1)
