"""Display formats (dot for thousands, comma for decimals)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .clean import _c

DASH = "—"


def fmt_num(value: Column | str) -> Column:
    text = F.format_number(_c(value).try_cast("bigint"), 0)
    return F.coalesce(F.replace(text, F.lit(","), F.lit(".")), F.lit(DASH))


def fmt_money(value: Column | str) -> Column:
    text = F.translate(F.format_number(_c(value), 2), ",.", " ,")
    return F.coalesce(F.concat(F.lit("R$ "), text), F.lit(DASH))


def fmt_percent(value: Column | str) -> Column:
    return F.format_string("%.2f%%", _c(value))


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100`` as a double, 0 when there is no whole."""
    part, whole = _c(part), _c(whole)
    return F.when(whole != 0, part.cast("double") / whole * 100).otherwise(F.lit(0.0))


def tick(flag: Column | str) -> Column:
    return F.when(_c(flag), "✓").otherwise("")


def coastal_label(flag: Column | str) -> Column:
    return F.when(_c(flag), "Coastal").otherwise("Interior")
