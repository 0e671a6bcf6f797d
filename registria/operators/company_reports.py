"""Reports that join establishments to the company master and the tax regime.

The masters have no unique key, and one key may hold much of a table. Each side
is therefore aggregated per company before the join, and the fan-out of
duplicates is computed as a product of counts instead of being produced as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, formats, regions
from ..session import checkpointed
from .joins import left_dim_unknown
from .quantile import weighted_percentile, weighted_percentiles
from .scope import Day, distinct_companies, in_range, prepare_fact
from .sets import union_parts
from .state_reports import count_if, region_rate, rows

KEY = "cnpj_basico"
COUNT = "decimal(19,0)"


def _regime(simples: DataFrame) -> DataFrame:
    """``cnpj_basico, regime_rows, regime_mei`` per company."""
    return simples.groupBy(KEY).agg(rows("regime_rows"), count_if(F.col("opcao_mei") == "S", "regime_mei"))


def _or(column: str, default: int) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def legal_nature_share(
    fact: DataFrame, empresas: DataFrame | None, natureza: DataFrame | None,
    ufs: Sequence[str] | None, start: Day, end: Day, top_n: int = 8,
) -> DataFrame | None:
    """Companies in scope per legal nature: ``nature, qty``; None without both dimensions."""
    if empresas is None or natureza is None:
        return None
    master = empresas.groupBy(KEY, clean.norm_code4("natureza_juridica").alias("code4")).agg(rows("copies"))
    per_code = (
        distinct_companies(fact, ufs, start, end).join(master, KEY, "left")
        .groupBy("code4").agg(F.sum(_or("copies", 1)).alias("qty"))
    )
    return left_dim_unknown(per_code, natureza).orderBy(F.desc("qty"), "nature").limit(top_n)


def top_naturezas(
    fact: DataFrame, empresas: DataFrame | None, natureza: DataFrame | None,
    ufs: Sequence[str] | None, start: Day, end: Day, top_n: int = 8,
) -> DataFrame | None:
    """``legal_nature_share`` under the column name ``natureza``."""
    share = legal_nature_share(fact, empresas, natureza, ufs, start, end, top_n)
    return None if share is None else share.withColumnRenamed("nature", "natureza")


def enterprise_profile(
    fact: DataFrame, empresas: DataFrame | None, simples: DataFrame | None, uf: str, start: Day, end: Day
) -> DataFrame | None:
    """One row ``n_emp, n_mei, avg_cap_raw, micro, small, medium, large`` for a state; None without companies."""
    if empresas is None:
        return None
    capital, bucket = clean.parse_capital("capital_social"), clean.size_bucket("porte_empresa")
    sizes = list(clean.SIZE_CODES)
    master = empresas.groupBy(KEY).agg(
        rows("master_rows"),
        F.sum(capital).cast("double").alias("cap_sum"),
        F.count(capital).alias("cap_rows"),
        *[count_if(bucket == size, size) for size in sizes],
    )
    companies = distinct_companies(fact, [uf], start, end).join(master, KEY, "left")
    if simples is None:
        companies = companies.withColumns({"regime_rows": F.lit(1), "regime_mei": F.lit(0)})
    else:
        companies = companies.join(_regime(simples), KEY, "left")
    # a company's master rows meet each of its regime rows
    emp, reg = _or("master_rows", 1), _or("regime_rows", 1)

    def total(expr: Column, name: str) -> Column:
        return F.coalesce(F.sum(expr), F.lit(0)).cast("bigint").alias(name)

    return companies.agg(
        total(emp * reg, "n_emp"),
        total(emp * _or("regime_mei", 0), "n_mei"),
        F.try_divide(F.sum(F.col("cap_sum") * reg), F.sum(F.col("cap_rows") * reg)).alias("avg_cap_raw"),
        *[total(F.col(size) * reg, size) for size in sizes],
    )


def presence(fact: DataFrame, start: Day, end: Day) -> DataFrame:
    """``uf, cnpj_basico, establishments, actives`` per state and company."""
    return (
        in_range(prepare_fact(fact), start, end).groupBy(F.col("uf_norm").alias("uf"), KEY)
        .agg(rows("establishments"), count_if(clean.is_active("status2"), "actives"))
    )


def region_mei_density(fact: DataFrame, simples: DataFrame | None, start: Day, end: Day) -> DataFrame:
    """``region, mei, total, mei_pct`` over distinct (state, company) pairs."""
    pairs = in_range(prepare_fact(fact), start, end).select(F.col("uf_norm").alias("uf"), KEY).distinct()
    return _mei_density(pairs, simples)


def _mei_density(pairs: DataFrame, simples: DataFrame | None) -> DataFrame:
    if simples is None:
        pairs = pairs.withColumns({"regime_rows": F.lit(1), "regime_mei": F.lit(0)})
    else:
        pairs = pairs.join(_regime(simples), KEY, "left")
    by_state = pairs.groupBy("uf").agg(
        F.sum(_or("regime_mei", 0)).alias("mei"), F.sum(_or("regime_rows", 1)).alias("total")
    )
    return region_rate(by_state, "mei", "total", "mei_pct")


def capital_histogram(held: DataFrame, empresas: DataFrame) -> DataFrame:
    """``uf, cap, times``: capital of the company of each establishment, equal values counted.

    ``held`` has ``uf, cnpj_basico, establishments``. Counts are decimals: where one
    company fills much of both tables, its pairs outgrow a long.
    """
    master = (
        empresas.select(KEY, clean.parse_capital("capital_social").alias("cap"))
        .where(F.col("cap").isNotNull()).groupBy(KEY, "cap").agg(rows("copies"))
    )
    return (
        held.where(F.col("uf").isNotNull()).join(master, KEY).groupBy("uf", "cap")
        .agg(F.sum(F.col("establishments").cast(COUNT) * F.col("copies").cast(COUNT)).alias("times"))
    )


def winsorized_capital(
    fact: DataFrame, empresas: DataFrame, start: Day, end: Day, q: str = "0.90"
) -> DataFrame:
    """``uf, n, p90, avg_cap_w``: mean capital per state with values above the percentile cut to it."""
    return _winsorized(capital_histogram(presence(fact, start, end), empresas), q)


def capital_percentiles(
    fact: DataFrame, empresas: DataFrame, start: Day, end: Day, qs: Sequence[str] = ("0.25", "0.50", "0.90")
) -> DataFrame:
    """``uf, n, q, p``: percentiles of capital per state, all of them from one histogram."""
    hist = capital_histogram(presence(fact, start, end), empresas)
    return weighted_percentiles(hist, "uf", "cap", "times", qs).withColumnRenamed("rows", "n")


def _winsorized(hist: DataFrame, q: str) -> DataFrame:
    cut = weighted_percentile(hist, "uf", "cap", "times", q)
    cap, times = F.least(F.col("cap").cast("double"), F.col("p")), F.col("times").cast("double")
    return (
        hist.join(cut, "uf").groupBy("uf", F.col("p").alias("p90"))
        .agg(F.sum("times").alias("n"), (F.sum(cap * times) / F.sum(times)).alias("avg_cap_w"))
        .select("uf", "n", "p90", "avg_cap_w")
    )


def region_capital(by_state: DataFrame) -> DataFrame:
    """``region, avg_cap``: plain mean of the state means."""
    return (
        by_state.groupBy(regions.region_of("uf").alias("region")).agg(F.avg("avg_cap_w").alias("avg_cap"))
        .where(F.col("region").isNotNull())
    )


def region_gap(
    fact: DataFrame, empresas: DataFrame | None, simples: DataFrame | None, start: Day, end: Day,
    first: str = "N", second: str = "SE",
) -> DataFrame:
    """``metric, first_value, second_value, gap`` for active rate, MEI density and mean capital.

    A metric whose table is missing is 0. The fact is read once: all three start
    from the stored (state, company) counts.
    """
    held = checkpointed(presence(fact, start, end))
    active = region_rate(held, "actives", "establishments", "active_pct")
    metrics = {"active_rate": (active, "active_pct"), "mei_density": (_mei_density(held, simples), "mei_pct")}
    if empresas is not None:
        capital = region_capital(_winsorized(capital_histogram(held, empresas), "0.90"))
        metrics["avg_capital"] = (capital, "avg_cap")
    else:
        metrics["avg_capital"] = (active.where(F.lit(False)), "active_pct")

    def compare(metric: str) -> DataFrame:
        by_region, column = metrics[metric]
        side = [
            F.coalesce(F.max(F.when(F.col("region") == region, F.col(column))), F.lit(0.0)).alias(name)
            for region, name in ((first, "first_value"), (second, "second_value"))
        ]
        values = by_region.agg(*side).select(F.lit(metric).alias("metric"), "first_value", "second_value")
        return values.withColumn("gap", F.col("first_value") - F.col("second_value"))

    return union_parts(*[compare(metric) for metric in metrics])
