"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_parts(*parts: DataFrame) -> DataFrame:
    """Bag union by column name: many files of one layout appended to one table."""
    return reduce(DataFrame.unionByName, parts)


def added(after: DataFrame, before: DataFrame) -> DataFrame:
    """Distinct rows of ``after`` that ``before`` lacks.

    Both sides are made distinct first; ``subtract`` alone would shuffle every copy.
    """
    return after.distinct().subtract(before.distinct())


def first_of_each(df: DataFrame, key: str, position: str) -> DataFrame:
    """One row per key ignoring case: the spelling that comes first by ``position``.

    ``min_by`` combines on the map side, so a key with many rows moves one row per task.
    """
    return (
        df.groupBy(F.lower(key).alias("folded"))
        .agg(F.min_by(key, position).alias(key), F.min(position).alias(position))
        .select(key, position)
    )


def first_per_group(df: DataFrame, group: str, value: str, position: str) -> DataFrame:
    """``value`` of the first row per group by ``position``."""
    return df.groupBy(group).agg(F.min_by(value, position).alias(value))
