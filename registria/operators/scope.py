"""The prepared fact and the filters every report shares.

State codes are compared after trimming and upper-casing everywhere, so rows
with a dirty state count the same in every report.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean

Day = str | date
ACTIVITY_COLUMNS = ["cnae_fiscal_principal", "cnae_fiscal", "cnae", "cnae_principal"]


def prepare_fact(fact: DataFrame) -> DataFrame:
    """Adds the typed columns the reports read: ``dt, uf_norm, mun_code, status2``.

    A published fact already carries them as stored columns; then the date range
    and the state reach the parquet scan. On staged text they are computed, and
    the optimizer drops those a report does not use.
    """
    types, opened = dict(fact.dtypes), F.col("data_inicio_atividades")
    typed = {
        "dt": opened if types.get("data_inicio_atividades") == "date" else clean.parse_date_prefix8(opened),
        "uf_norm": clean.norm_uf("uf"),
        "mun_code": clean.trim_code("municipio"),
        "status2": clean.norm_status("situacao_cadastral"),
    }
    source = {
        "dt": "data_inicio_atividades", "uf_norm": "uf",
        "mun_code": "municipio", "status2": "situacao_cadastral",
    }
    return fact.withColumns(
        {name: expr for name, expr in typed.items() if name not in types and source[name] in types}
    )


def day(value: Day) -> Column:
    return F.lit(str(value)).cast("date")


def in_range(df: DataFrame, start: Day, end: Day, column: str = "dt") -> DataFrame:
    """Rows dated ``start``..``end``, both included; reversed bounds are swapped.

    A stored date is compared as it is, so the range reaches the scan. A date
    still to be parsed from text is named once, since the filter parses it anew
    for each mention: its distance from the middle of the range decides.
    """
    low, high = sorted(date.fromisoformat(str(d)) for d in (start, end))
    if column == "dt" and dict(df.dtypes).get("data_inicio_atividades") == "string":
        days = (high - low).days
        return df.where(F.abs(F.date_diff(column, day(low)) * 2 - days) <= days)
    return df.where(F.col(column).between(day(low), day(high)))


def default_range(today: date, months: int = 12) -> tuple[date, date]:
    """The picker's range: ``months`` times thirty days up to ``today``."""
    return today - timedelta(days=30 * months), today


def last_months(end: Day, months: int) -> tuple[date, date]:
    """First and last day of the ``months`` calendar months that end with the month of ``end``."""
    count = int(str(end)[:4]) * 12 + int(str(end)[5:7]) - 1

    def first_of(month: int) -> date:
        return date(month // 12, month % 12 + 1, 1)

    return first_of(count - months + 1), first_of(count + 1) - timedelta(days=1)


def clean_states(ufs: Sequence[str] | None) -> list[str]:
    """Trimmed, upper-cased, distinct, in the order given."""
    return list(dict.fromkeys(u.strip().upper() for u in ufs or [] if u and u.strip()))


def in_states(df: DataFrame, ufs: Sequence[str] | None, column: str = "uf_norm") -> DataFrame:
    """Rows of the given states; no state given means every row."""
    states = clean_states(ufs)
    return df.where(F.col(column).isin(states)) if states else df


def scoped(fact: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day) -> DataFrame:
    return in_range(in_states(prepare_fact(fact), ufs), start, end)


def text_search(df: DataFrame, column: str, needle: str, upper: bool = False) -> DataFrame:
    """Rows whose text contains the pattern ``needle``.

    ``upper`` folds both sides to upper case; otherwise the match ignores case.
    A blank needle keeps every row.
    """
    needle = needle.strip()
    if not needle:
        return df
    hit = F.upper(column).rlike(needle.upper()) if upper else F.col(column).rlike("(?i)" + needle)
    return df.where(F.coalesce(hit, F.lit(False)))


def distinct_companies(fact: DataFrame, ufs: Sequence[str] | None, start: Day, end: Day) -> DataFrame:
    """One row per company with an establishment in scope."""
    return scoped(fact, ufs, start, end).select("cnpj_basico").distinct()


def activity_column(fact: DataFrame) -> str | None:
    """First activity-code column the fact has."""
    return next((c for c in ACTIVITY_COLUMNS if c in fact.columns), None)
