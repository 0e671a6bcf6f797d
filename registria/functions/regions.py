"""State lookups. The maps are constants, so they travel as literals, not as joins."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from .clean import _c

# States of each macro-region, region labels, Atlantic states.
REGION_STATES = {
    "N": ["RO", "AC", "AM", "RR", "PA", "AP", "TO"],
    "NE": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "CO": ["MT", "MS", "GO", "DF"],
    "SE": ["SP", "RJ", "ES", "MG"],
    "S": ["PR", "SC", "RS"],
}
REGION_LABEL = {
    "N": "North",
    "NE": "Northeast",
    "CO": "Center-West",
    "SE": "Southeast",
    "S": "South",
}
COASTAL_STATES = [
    "AP", "PA", "MA", "PI", "CE", "RN", "PB", "PE", "AL",
    "SE", "BA", "ES", "RJ", "SP", "PR", "SC", "RS",
]


def region_of(uf: Column | str) -> Column:
    """Macro-region code; NULL for an unknown state."""
    pairs = [(s, region) for region, states in REGION_STATES.items() for s in states]
    return F.create_map(*[F.lit(x) for x in chain(*pairs)])[_c(uf)]


def region_label(region: Column | str) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*REGION_LABEL.items())])[_c(region)]


def is_coastal(uf: Column | str) -> Column:
    return F.coalesce(F.upper(_c(uf)).isin(COASTAL_STATES), F.lit(False))
