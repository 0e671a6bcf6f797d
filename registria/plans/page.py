"""All frames of the geography page for one selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields
from datetime import date

from pyspark.sql import DataFrame

from ..operators import city_reports, company_reports, quality, state_reports
from ..operators.scope import Day, clean_states
from . import products
from .resolve import Registry


def missing_tables(registry: Registry) -> list[str]:
    """Tables whose absence makes some frame smaller."""
    return [f.name for f in fields(registry) if getattr(registry, f.name) is None]


def yearly_range(today: date, years: int = 10, first_year: int = 2000) -> tuple[date, date]:
    """The yearly chart's own range: the last ``years`` years, not before ``first_year``."""
    year = max(today.year - years, first_year)
    leap_day = (today.month, today.day) == (2, 29)
    return today.replace(year=year, day=28 if leap_day and year % 4 else today.day), today


def geography(
    registry: Registry, start: Day, end: Day, selected: Sequence[str] = (),
    yearly: tuple[Day, Day] | None = None,
) -> dict[str, DataFrame]:
    """Name to frame. Without a selection the page covers all states.

    The first selected state in alphabetical order is the one looked at by city
    and by month. Frames that need a missing table or a selection are left out.
    Nothing runs until a frame is read, save the stored counts of ``region_gap``.
    """
    if registry.fact is None:
        raise ValueError("no establishments table with rows")
    fact, states = registry.fact, sorted(clean_states(selected))
    stock = state_reports.uf_stock(fact, start, end)
    frames = {
        "kpis": state_reports.kpi_totals(stock, states),
        "active_rate": state_reports.active_rate(fact, start, end),
        "last_month": quality.last_available_month(fact),
        "coverage": quality.coverage_pct(quality.data_quality(fact)),
        "stock": stock,
        "value_range": state_reports.value_range(stock),
        "nature": products.nature_or_status(
            fact, registry.empresas, registry.natureza_juridica, states, start, end
        ),
        "state_summary": products.state_summary(stock, states),
        "openings_by_year": state_reports.openings_by_year(fact, states, *(yearly or (start, end))),
        "coastal_inland": state_reports.coastal_inland(stock),
        "region_gap": company_reports.region_gap(fact, registry.empresas, registry.simples, start, end),
    }
    if states:
        focus = states[0]
        frames["cities"] = products.city_drilldown(fact, registry.municipio, focus, start, end)
        frames["openings_last_12mo"] = state_reports.openings_last_12mo(fact, focus, end)
        if registry.municipio is not None:
            frames["top5_concentration"] = city_reports.top5_concentration(
                fact, registry.municipio, start, end, [focus]
            )
    return frames
