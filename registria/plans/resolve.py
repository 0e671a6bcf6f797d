"""Which table to read: published before staged, and only if it has a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .versions import RUNS, Version

FACT = "estabelecimento"
STAGED = "temp_"


def _databases(spark: SparkSession, first: Sequence[str] = ()) -> list[str]:
    """All databases: those named ``first`` in that order, then the others by name. Tables of single runs do not count."""
    known = sorted(db.name for db in spark.catalog.listDatabases() if not db.name.endswith(RUNS))
    wanted = [db for db in dict.fromkeys(first) if db in known]
    return wanted + [db for db in known if db not in wanted]


def _has_rows(spark: SparkSession, table: str) -> bool:
    try:
        return spark.catalog.tableExists(table) and not spark.table(table).isEmpty()
    except Exception:  # unreadable counts as absent: try the next one
        return False


def first_table(spark: SparkSession, names: Sequence[str], databases: Sequence[str] = ()) -> str | None:
    """First of ``names``, over all databases, that exists and has a row; a name comes before a database."""
    candidates = [f"{db}.{name}" for name in names for db in _databases(spark, databases)]
    return next((t for t in candidates if _has_rows(spark, t)), None)


def fact_candidates(spark: SparkSession, first: Sequence[str] = ()) -> list[str]:
    """Published facts, staged facts, then any table with a like name; the first mention of a table counts."""
    databases = _databases(spark, first)
    named = [f"{db}.{FACT}" for db in databases] + [f"{db}.{STAGED}{FACT}" for db in databases]
    found = sorted(
        f"{db}.{t.name}" for db in databases for t in spark.catalog.listTables(db)
        if not t.isTemporary and "estabele" in t.name.lower()
    )
    places: dict[str, str] = {}
    for table in named + found:
        places.setdefault(table.lower(), table)
    return list(places.values())


def fact_table(spark: SparkSession, databases: Sequence[str] = ()) -> str | None:
    return next((t for t in fact_candidates(spark, databases) if _has_rows(spark, t)), None)


@dataclass
class Registry:
    """The tables a report needs; those that are missing are None."""

    fact: DataFrame | None
    empresas: DataFrame | None
    simples: DataFrame | None
    natureza_juridica: DataFrame | None
    municipio: DataFrame | None

    @classmethod
    def find(cls, spark: SparkSession, databases: Sequence[str] = ()) -> Registry:
        """Tables of ``databases`` are preferred, in that order, among those of one kind."""

        def table(name: str | None) -> DataFrame | None:
            return spark.table(name) if name else None

        dims = ("empresas", "simples", "natureza_juridica", "municipio")
        found = {d: table(first_table(spark, [d, STAGED + d], databases)) for d in dims}
        return cls(fact=table(fact_table(spark, databases)), **found)

    @classmethod
    def of(cls, spark: SparkSession, version: Version) -> Registry:
        """Tables of one published version: all of one run's publication, however many follow."""
        names = {"fact": FACT} | {d: d for d in ("empresas", "simples", "natureza_juridica", "municipio")}
        return cls(**{k: version.table(spark, name) if name in version.tables else None for k, name in names.items()})
