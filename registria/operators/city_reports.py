"""Reports by city. Rows are counted per code before any join, so the join sees
at most one row per state and code, however many rows one city holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import formats
from .joins import inner_dim
from .ranking import dense_rank_by, row_number_all, top_per_group
from .scope import Day, scoped, text_search
from .state_reports import rows


def code_counts(
    fact: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day, trimmed: bool = True
) -> DataFrame:
    """``uf, code, qty`` per municipality code."""
    code = F.col("mun_code" if trimmed else "municipio")
    return (
        scoped(fact, ufs, start, end)
        .groupBy(F.col("uf_norm").alias("uf"), code.alias("code")).agg(rows())
    )


def city_counts(
    fact: DataFrame, municipio: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day,
    trimmed: bool = True,
) -> DataFrame:
    """``uf, municipio, qty`` for cities with a name. See ``joins.inner_dim`` for ``trimmed``."""
    return inner_dim(code_counts(fact, ufs, start, end, trimmed), municipio, trimmed)


def city_ranking(
    fact: DataFrame, municipio: DataFrame | None, uf: str, start: Day, end: Day, limit_n: int = 50
) -> DataFrame:
    """Largest cities of one state: ``municipio, qty``. Without a dimension, the raw codes."""
    if municipio is None:
        counts = code_counts(fact, [uf], start, end).where(F.col("code") != "")
        named = counts.select(F.col("code").alias("municipio"), "qty")
    else:
        named = city_counts(fact, municipio, [uf], start, end).select("municipio", "qty")
    return named.orderBy(F.desc("qty"), "municipio").limit(max(1, limit_n))


def city_row_number(fact: DataFrame, municipio: DataFrame, start: Day, end: Day) -> DataFrame:
    """``uf, municipio, qty, rn``: every city numbered within its state, largest first."""
    cities = city_counts(fact, municipio, None, start, end, trimmed=False)
    return row_number_all(cities, "uf", [F.desc("qty"), F.col("municipio")])


def top5_concentration(
    fact: DataFrame, municipio: DataFrame | None, start: Day, end: Day, ufs: Sequence[str] | None = None
) -> DataFrame | None:
    """``uf, top5, total, top5_pct``: share of the five largest named cities of a state; None without cities."""
    if municipio is None:
        return None
    cities = city_counts(fact, municipio, ufs, start, end, trimmed=False)
    top = top_per_group(cities, "uf", [F.desc("qty"), F.col("municipio")], 5)
    top5 = top.groupBy("uf").agg(F.sum("qty").alias("top5"))
    total = cities.groupBy("uf").agg(F.sum("qty").alias("total"))
    # NULL-safe: establishments without a state form a group of their own
    joined = total.join(top5, total["uf"].eqNullSafe(top5["uf"])).select(total["uf"], "top5", "total")
    return joined.withColumn("top5_pct", formats.percent("top5", "total"))


def top_city_share(cities: DataFrame) -> DataFrame:
    """One row ``uf_total, top_city, top_qty, top_pct`` over a listed ranking.

    The share is of the listed cities only; pass an unlimited ranking for the
    share of the whole state.
    """
    listed = cities.agg(
        F.coalesce(F.sum("qty"), F.lit(0)).alias("uf_total"),
        F.min_by("municipio", F.struct(F.negative("qty"), "municipio")).alias("top_city"),
        F.max("qty").alias("top_qty"),
    )
    return listed.withColumn("top_pct", formats.percent("top_qty", "uf_total"))


def city_rank(cities: DataFrame, search: str = "", top_n: int = 15) -> DataFrame:
    """``rank, municipio, qty`` of a listed ranking: search, cut, then rank what is left."""
    listed = text_search(cities, "municipio", search).orderBy(F.desc("qty"), "municipio").limit(top_n)
    return dense_rank_by(listed).select("rank", "municipio", "qty")
