"""Ranks, shares and row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed


def dense_rank_by(df: DataFrame, value: str = "qty", name: str = "rank") -> DataFrame:
    """Dense rank, largest first. For reports of bounded length (states, a top-n list)."""
    return df.withColumn(name, F.dense_rank().over(Window.orderBy(F.desc(value))))


def share_of_total(df: DataFrame, value: str = "qty", name: str = "share_percent") -> DataFrame:
    """Percent of the grand total, two places, halves to even; 0 if the total is 0."""
    total = F.sum(value).over(Window.partitionBy())
    share = F.bround(F.col(value).cast("double") / total * 100, 2)
    return df.withColumn(name, F.when(total != 0, share).otherwise(F.lit(0.0)))


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark limits each task's share of a group before the shuffle (window group
    limit), so a group of any size sends at most ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rn", rank).where(F.col("rn") <= n)


def row_number_all(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``row_number`` over every row of every group without gathering a group in one task.

    A global sort range-partitions the rows, cutting large groups (and ties)
    across tasks. The position inside a partition plus the group's rows in the
    partitions before it is the row number. ``order`` must be total within the
    group. The sorted rows are checkpointed so both reads see one numbering.
    """
    placed = checkpointed(
        df.orderBy(F.col(group), *order).withColumn("_id", F.monotonically_increasing_id())
    )
    pid = F.shiftright("_id", 33)  # the high bits of the id are the partition
    pieces = (
        placed.groupBy(group, pid.alias("_pid"))
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        # one row per (group, partition): as short as the list of partitions
        .withColumn(
            "_before",
            F.sum("_rows").over(
                Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(F.col(group).alias("_group"), "_pid", "_first", "_before")
    )
    same = placed[group].eqNullSafe(pieces["_group"]) & (pid == pieces["_pid"])
    return (
        placed.join(pieces, same)
        .withColumn("rn", F.col("_id") - F.col("_first") + F.coalesce("_before", F.lit(0)) + 1)
        .select(*df.columns, "rn")
    )
