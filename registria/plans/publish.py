"""Hardening, the publication gate and the publication itself."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean
from ..operators.scope import prepare_fact
from ..sources.layouts import DATE_COLUMNS, TABLES
from . import versions

REPORT = "table string, action string, path string, error string"


def harden_dates(layout: str, df: DataFrame) -> DataFrame:
    """Text dates of the layout as DATE; absent columns and real dates are left alone."""
    types = dict(df.dtypes)
    dates = [c for c in DATE_COLUMNS.get(layout, []) if types.get(c) == "string"]
    return df.withColumns({c: clean.parse_date_exact8(c) for c in dates}) if dates else df


def curated(layout: str, df: DataFrame) -> DataFrame:
    """The table as published: hardened, and for the fact with its typed columns stored."""
    df = harden_dates(layout, df)
    return prepare_fact(df).drop("dt") if layout == "estabelecimento" else df


def clustered(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The fact ordered by start date over the whole table, so a date range reads few row groups.

    Ties are cut by company, order number and at last the row's place in the
    input, so neither a full date nor a row with many copies makes a large task.
    """
    keys = ["data_inicio_atividades", "cnpj_basico", "cnpj_ordem", "_place"]
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    return placed.sortWithinPartitions(*keys).drop("_place")


def promote(
    spark: SparkSession, staged: Mapping[str, DataFrame], status: bool, root: str, run_id: str,
    database: str = "curated", fact_partitions: int | None = None, all_or_nothing: bool = False,
) -> DataFrame:
    """Publishes each staged table: ``table, action, path, error``.

    With ``status`` false nothing is touched. Every table is written to a new folder; then one new
    version names them all (``versions``), so readers of versions see the tables of this run together
    or those before, and views by name follow. A run that ends before leaves the earlier version in force.

    A table that fails is reported and the others go on, beside its last good one; with
    ``all_or_nothing`` the run is withheld instead. Kinds with nothing staged are reported as skipped.
    """
    report, written = [], {}
    for name, df in staged.items():
        if not status:
            report.append((name, "skipped", None, "load reported errors"))
            continue
        path = f"{root.rstrip('/')}/{name}/{run_id}-{uuid.uuid4().hex[:8]}"
        try:
            out = curated(name, df)
            if name == "estabelecimento":
                out = clustered(out, fact_partitions)
            out.write.parquet(path)
            written[name] = path
        except Exception as error:  # one bad table must not stop the rest
            report.append((name, "failed", path, f"{type(error).__name__}: {error}"))
    if all_or_nothing and any(action == "failed" for _, action, _, _ in report):
        report += [(name, "withheld", path, "another table failed") for name, path in written.items()]
    elif written:
        versions.show(spark, database, versions.publish(spark, root, run_id, written))
        report += [(name, "promoted", path, None) for name, path in written.items()]
    report += [(name, "skipped", None, "nothing staged") for name in TABLES if name not in staged]
    return spark.createDataFrame(report, REPORT)


def export_csv(df: DataFrame, path: str) -> None:
    """Raw values with a header, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def city_export_name(uf: str, start: str, end: str) -> str:
    return f"cities_{uf.lower()}_{start}_to_{end}"


def city_export(cities: DataFrame) -> DataFrame:
    return cities.select(F.col("municipio").alias("city"), F.col("qty").alias("companies"))
