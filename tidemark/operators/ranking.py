"""Ranks within groups of any size."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

# Groups up to this size are ranked by one task each.
TASK_ROWS = 1_000_000

#: Slices of a group at most: each of its values is compared with all their limits.
MOST_SLICES = 256


def rank_desc(
    df: DataFrame,
    group: str,
    value: str,
    at_most: int,
    name: str = "Rank",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the rank of ``value`` within ``group``, largest first, nulls last.

    ``at_most`` bounds the rows of a group. Beyond ``task_rows`` no group goes
    to one task: its distinct values are counted and cut into slices by value,
    and a rank is the number of rows in higher slices plus those above it in
    its own. Slice limits only balance the work; any limits give the same rank. There are
    ``MOST_SLICES`` at most, so that the work stays in proportion to the rows.
    """
    if at_most <= task_rows:
        order = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(name, F.rank().over(order).cast("long"))

    rows = staged(df, "rank-rows")
    slices = min(ceil(at_most / task_rows) + 1, MOST_SLICES)
    cuts = [i / slices for i in range(1, slices)]
    limits = staged(
        rows.groupBy(F.col(group).alias("_group")).agg(
            F.percentile_approx(value, cuts, 100 * slices).alias("_limits")
        ),
        "rank-limits",
    )
    higher = F.size(F.filter("_limits", lambda limit: limit > F.col("_value")))
    counted = (
        rows.groupBy(F.col(group).alias("_group"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(limits.withColumnRenamed("_group", "_lg"), F.col("_group").eqNullSafe(F.col("_lg")))
        .withColumn("_slice", F.when(F.col("_value").isNull(), slices).otherwise(higher))
        .select("_group", "_value", "_n", "_slice")
    )
    above = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = above.partitionBy("_group", "_slice").orderBy(F.col("_value").desc_nulls_last())
    before = above.partitionBy("_group").orderBy("_slice")
    totals = (
        counted.groupBy("_group", "_slice")
        .agg(F.sum("_n").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .select(F.struct("_group", "_slice").alias("_place"), "_before")
    )
    ranks = (
        counted.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .withColumn("_place", F.struct("_group", "_slice"))
        .join(totals, "_place")
        .select(
            F.struct(F.col("_group").alias("g"), F.col("_value").alias("v")).alias("_at"),
            (F.col("_before") + F.col("_within") + 1).alias(name),
        )
    )
    at = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    return rows.withColumn("_at", at).join(ranks, "_at").drop("_at")
