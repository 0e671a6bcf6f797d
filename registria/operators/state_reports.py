"""Reports by state, year, month and status.

Each is one pass with partial aggregation: a state with a third of the rows
leaves one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, formats, regions
from .joins import calendar_spine
from .scope import Day, activity_column, day, in_range, in_states, last_months, prepare_fact, scoped


def rows(name: str = "qty") -> Column:
    return F.count(F.lit(1)).alias(name)


def count_if(condition: Column, name: str) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).alias(name)


def uf_stock(fact: DataFrame, start: Day, end: Day) -> DataFrame:
    """Establishments per state: ``uf, qty``, largest first."""
    located = in_range(prepare_fact(fact), start, end).where(F.col("uf_norm") != "")
    return located.groupBy(F.col("uf_norm").alias("uf")).agg(rows()).orderBy(F.desc("qty"), "uf")


def openings_by_year(
    fact: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day, years_limit: int | None = None
) -> DataFrame:
    """``year, openings``, oldest first; a limit keeps the oldest years."""
    years = (
        scoped(fact, ufs, start, end)
        .groupBy(F.year("dt").alias("year")).agg(rows("openings"))
        .orderBy("year")
    )
    return years if years_limit is None else years.limit(max(1, years_limit))


def openings_last_12mo(fact: DataFrame, uf: str, end: Day) -> DataFrame:
    """``month, openings`` for the 12 months up to the whole month of ``end``."""
    first, last = last_months(end, 12)
    monthly = (
        scoped(fact, [uf], first, last)
        .groupBy(clean.month_floor("dt").alias("month")).agg(rows("openings"))
    )
    return calendar_spine(monthly, day(first), day(last)).orderBy("month")


def status_share(fact: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day) -> DataFrame:
    """``status, qty``; any status but the active code, NULL included, is inactive."""
    return (
        scoped(fact, ufs, start, end)
        .groupBy(clean.status_label("status2").alias("status")).agg(rows())
        .orderBy(F.desc("qty"), "status")
    )


def cnae_profile(fact: DataFrame, uf: str, start: Day, end: Day, top_n: int = 10) -> DataFrame | None:
    """Largest activity divisions of a state: ``division2, qty``; None without an activity column."""
    column = activity_column(fact)
    if column is None:
        return None
    return (
        scoped(fact, [uf], start, end)
        .select(clean.cnae_division(column).alias("division2")).where(F.col("division2").isNotNull())
        .groupBy("division2").agg(rows())
        .orderBy(F.desc("qty"), "division2").limit(top_n)
    )


def active_rate(fact: DataFrame, start: Day, end: Day) -> DataFrame:
    """One row ``active, total, active_pct`` over all states."""
    counted = in_range(prepare_fact(fact), start, end).agg(
        count_if(clean.is_active("status2"), "active"), rows("total")
    )
    return counted.withColumn("active_pct", formats.percent("active", "total"))


def region_active_rate(fact: DataFrame, start: Day, end: Day) -> DataFrame:
    """``region, actives, total, active_pct`` over states with a region."""
    by_state = (
        in_range(prepare_fact(fact), start, end).groupBy(F.col("uf_norm").alias("uf"))
        .agg(count_if(clean.is_active("status2"), "actives"), rows("total"))
    )
    return region_rate(by_state, "actives", "total", "active_pct")


def region_rate(by_state: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """State sums added up per region, with their ratio in percent."""
    return (
        by_state.groupBy(regions.region_of("uf").alias("region"))
        .agg(F.sum(part).alias(part), F.sum(whole).alias(whole))
        .where(F.col("region").isNotNull())
        .withColumn(name, formats.percent(part, whole))
    )


def kpi_totals(stock: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """One row ``establishments, leader_uf, leader_qty`` for the selected states, or all."""
    return in_states(stock, selected, "uf").agg(
        F.coalesce(F.sum("qty"), F.lit(0)).alias("establishments"),
        F.min_by("uf", F.struct(F.negative("qty"), "uf")).alias("leader_uf"),
        F.max("qty").alias("leader_qty"),
    )


def coastal_inland(stock: DataFrame) -> DataFrame:
    """One row ``coastal, inland``; an unknown state counts as inland."""
    qty, coastal = F.col("qty"), regions.is_coastal("uf")
    return stock.agg(
        F.coalesce(F.sum(F.when(coastal, qty)), F.lit(0)).alias("coastal"),
        F.coalesce(F.sum(F.when(~coastal, qty)), F.lit(0)).alias("inland"),
    )


def scale_bounds(low: str, high: str) -> dict[str, Column]:
    """``vmin, vmax`` of a colour scale, widened by one when both ends are equal."""
    low_, high_ = F.col(low), F.col(high)
    same = low_ == high_
    return {
        "vmin": F.when(same, F.greatest(low_ - 1, F.lit(0))).otherwise(low_).cast("bigint"),
        "vmax": F.when(same, high_ + 1).otherwise(high_).cast("bigint"),
    }


def value_range(stock: DataFrame) -> DataFrame:
    """One row ``vmin, vmax`` over the counts; 0 and 1 without a row."""
    ends = stock.agg(
        F.coalesce(F.min("qty"), F.lit(0)).alias("_low"), F.coalesce(F.max("qty"), F.lit(1)).alias("_high")
    )
    return ends.withColumns(scale_bounds("_low", "_high")).drop("_low", "_high")
