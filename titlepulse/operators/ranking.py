"""Ranks and top-k inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.sources.shared import stage

SPREAD = 32


def top_within(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group, with their 1-based rank.

    Two rounds: within slices of a group, then among the slices' winners.  Spark cuts each group to ``k`` rows
    before either shuffle, so one task of the last round sees at most ``SPREAD * k`` rows of a group.
    """
    sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    first = Window.partitionBy(*group, "_slice").orderBy(*order)
    last = Window.partitionBy(*group).orderBy(*order)
    winners = sliced.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= k)
    return (
        winners.drop("_slice", "_rank").withColumn(rank, F.row_number().over(last)).where(F.col(rank) <= k)
    )


def rank_within(df: DataFrame, group: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Exact 1..n position of every row in its group; ``order`` must leave no ties.

    No group is sorted by one task.  Rows are range-partitioned over group and order together, so a large group
    covers many neighbouring slices; the position is the row's place in its slice plus the number of the
    group's rows in earlier slices.  The slices are written down first: both uses must see the same cut.
    """
    slices = stage(
        df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()), "rank-slices"
    )
    inside = Window.partitionBy("_slice", *group).orderBy(*order)
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a slice can have rows in earlier ones, so this is at most one row per slice: its
    # size is bounded by the number of shuffle partitions.
    open_groups = (
        slices.groupBy("_slice", *group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.struct(*group).alias("_open"), F.sum("_rows").over(earlier).alias("_before"))
        .where("_before > 0")
    )
    placed = slices.withColumn("_place", F.row_number().over(inside))
    before = F.when(F.struct(*group).eqNullSafe(F.col("_open")), F.col("_before")).otherwise(F.lit(0))
    return placed.join(F.broadcast(open_groups), "_slice", "left").select(
        *df.columns, (F.col("_place") + before).cast("int").alias(rank)
    )
