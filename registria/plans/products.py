"""Composite reports: what a user of the dashboard asks for in one go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import clean, formats, regions
from ..operators import city_reports, company_reports, state_reports
from ..operators.ranking import dense_rank_by, share_of_total
from ..operators.scope import Day, clean_states, text_search


def state_table(stock: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """Every state with rank, region, coastal flag, share and selection."""
    states = clean_states(selected)
    return (
        share_of_total(dense_rank_by(stock))
        .withColumns({
            "region": regions.region_of("uf"),
            "coastal": regions.is_coastal("uf"),
            "selected": F.col("uf").isin(states) if states else F.lit(False),
        })
        .select("rank", "uf", "region", "coastal", "qty", "share_percent", "selected")
    )


def state_summary(
    stock: DataFrame, selected: Sequence[str] | None = None, only_selected: bool = False,
    region: str = "All", search: str = "", top_n: int = 15,
) -> DataFrame:
    """``state_table`` filtered; selected states first, then by size; first ``top_n``.

    Rank and share are taken before the filters.
    """
    view = state_table(stock, selected)
    if only_selected:
        view = view.where("selected")
    if region != "All":
        view = view.where(F.col("region") == region)
    view = text_search(view, "uf", search, upper=True)
    return view.orderBy(F.desc("selected"), F.desc("qty"), "uf").limit(top_n)


def state_summary_pretty(summary: DataFrame) -> DataFrame:
    """Display texts of a state summary."""
    return summary.select(
        F.col("rank").alias("Rank"), F.col("uf").alias("UF"), F.col("region").alias("Region"),
        formats.coastal_label("coastal").alias("Coastal"),
        formats.fmt_num("qty").alias("Establishments"),
        formats.fmt_percent("share_percent").alias("Share"),
        formats.tick("selected").alias("Selected"),
    )


def state_summary_export(summary: DataFrame) -> DataFrame:
    """Raw values under the export's column names."""
    return summary.select(
        F.col("rank").alias("Rank"), F.col("uf").alias("UF"), F.col("region").alias("Region"),
        F.col("coastal").alias("Coastal"), F.col("qty").alias("Establishments"),
        F.col("share_percent").alias("Share_percent"), F.col("selected").alias("Selected"),
    )


def city_drilldown(
    fact: DataFrame, municipio: DataFrame | None, uf: str, start: Day, end: Day,
    search: str = "", top_n: int = 15, listed: int = 100,
) -> DataFrame:
    """``rank, municipio, qty`` of a state's cities, each with the headline figures.

    Figures cover the ``listed`` largest cities; ``top_n`` of those that match
    ``search`` are shown.
    """
    cities = city_reports.city_ranking(fact, municipio, uf, start, end, listed)
    whole = Window.partitionBy()  # the listed cities only, at most ``listed`` rows
    headline = cities.withColumns({
        "uf_total": F.sum("qty").over(whole),
        "top_city": F.min_by("municipio", F.struct(F.negative("qty"), "municipio")).over(whole),
        "top_qty": F.max("qty").over(whole),
    }).withColumn("top_pct", formats.percent("top_qty", "uf_total"))
    shown = text_search(headline, "municipio", search).orderBy(F.desc("qty"), "municipio").limit(top_n)
    return dense_rank_by(shown)


def nature_or_status(
    fact: DataFrame, empresas: DataFrame | None, natureza: DataFrame | None,
    ufs: Sequence[str] | None, start: Day, end: Day, top_n: int = 8,
) -> DataFrame:
    """``label, qty`` by legal nature, or by status when a dimension is missing.

    Companies in range always have a nature, if only ``Unknown``, so both are
    empty together and no second fallback is needed.
    """
    nature = company_reports.legal_nature_share(fact, empresas, natureza, ufs, start, end, top_n)
    if nature is not None:
        return nature.withColumnRenamed("nature", "label")
    return state_reports.status_share(fact, ufs, start, end).withColumnRenamed("status", "label")


def map_frame(
    stock: DataFrame, features: DataFrame, selected: Sequence[str] | None = None
) -> DataFrame:
    """``uf, qty, lon, lat, selected, vmin, vmax`` for the states that have a shape.

    ``features`` is ``geometry.centroids``: ``uf, lon, lat``.
    """
    states = clean_states(selected)
    whole = Window.partitionBy()  # one row per state
    low, high = F.min("qty").over(whole), F.max("qty").over(whole)
    return (
        stock.withColumns({"_low": low, "_high": high})
        .withColumns(state_reports.scale_bounds("_low", "_high")).drop("_low", "_high")
        .join(features, "uf")
        .withColumn("selected", F.col("uf").isin(states) if states else F.lit(False))
    )


def positive_series(df: DataFrame, names: str, values: str) -> DataFrame:
    """Share-chart series: values as numbers, anything unreadable 0, only those above 0."""
    numbers = df.select(names, clean.to_number(values).alias(values))
    return numbers.where(F.col(values) > 0)


def dated_series(df: DataFrame, year: str = "year", values: str = "openings") -> DataFrame:
    """Line-chart series: rows with a readable year, unreadable values 0, oldest first."""
    numbers = df.select(F.col(year).try_cast("int").alias(year), clean.to_number(values).alias(values))
    return numbers.where(F.col(year).isNotNull()).orderBy(year)
