"""Coverage counters and row validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, formats
from .scope import prepare_fact
from .state_reports import count_if, rows


def data_quality(fact: DataFrame) -> DataFrame:
    """One row ``total, miss_uf, miss_mun, miss_dt``.

    A date counts as missing below eight digits, so eight zeros count as present.
    """
    short = F.length(clean.digits("data_inicio_atividades")) < 8
    return fact.agg(
        rows("total"),
        count_if(clean.is_blank("uf"), "miss_uf"),
        count_if(clean.is_blank("municipio"), "miss_mun"),
        count_if(F.coalesce(short, F.lit(True)), "miss_dt"),
    )


def coverage_pct(quality: DataFrame) -> DataFrame:
    """Percentages of ``data_quality``'s counters."""
    return quality.select(
        *[formats.percent(c, "total").alias(f"{c}_pct") for c in ("miss_uf", "miss_mun", "miss_dt")]
    )


def last_available_month(fact: DataFrame) -> DataFrame:
    """One row ``last_month``: latest start as ``yyyy-MM``, NULL when there is none."""
    return prepare_fact(fact).agg(clean.month_label(F.max("dt")).alias("last_month"))


def date_classes(df: DataFrame, column: str) -> DataFrame:
    """Rows per date class (valid, empty, garbage): ``class, qty``."""
    return df.groupBy(clean.date_class(column).alias("class")).agg(rows())


def violation_reasons(required: list[str], widths: dict[str, int]) -> Column:
    """Array of ``null:<column>`` and ``length:<column>`` for a row, empty if it is sound."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in required]
    checks += [F.when(F.length(F.rtrim(c)) > n, F.lit(f"length:{c}")) for c, n in widths.items()]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def violations(df: DataFrame, required: list[str] | None = None, widths: dict[str, int] | None = None) -> DataFrame:
    """``reason, qty`` over all checks in one pass."""
    reasons = violation_reasons(required or [], widths or {})
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(rows())


def split_sound(df: DataFrame, required: list[str], widths: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and the rest with their ``reasons`` for quarantine."""
    marked = df.withColumn("reasons", violation_reasons(required, widths))
    sound = F.size("reasons") == 0
    return marked.where(sound).drop("reasons"), marked.where(~sound)
