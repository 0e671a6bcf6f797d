"""One archive loaded by itself, with the count of its records as a gate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..sources import archives, delimited, layouts
from ..sources.content import contents
from ..sources.files import list_files, literal, qualified
from . import quarantine
from .ingest import Facts, exists, stage_file, staged_units

REPORT = ("archive string, member string, file string, layout string, counted long, read long, staged long, rejected long,"
          " status string, error string")
EXTRA = [delimited.CORRUPT, delimited.SOURCE, *delimited.PLACE, "reasons", "sound"]


@dataclass
class Loaded:
    """Staged rows per layout, the quarantine, one report row per member, and whether the gate is open."""

    tables: dict[str, DataFrame]
    quarantine: DataFrame
    report: DataFrame
    ok: bool


def load_archive(
    spark: SparkSession, archive: str, work: str, expected: int | None = None, layout: str | None = None,
    whole: bool = False, run_id: str = "",
) -> Loaded:
    """Extracts and stages the main member of one archive, its largest CSV-like one (``whole``: every member).

    The gate is open if each member is read and every record is accounted for: rows staged plus rows set
    aside equal the records counted in the bytes by lines and quotes alone, and, where the sender
    names a count, ``expected`` in all. ``layout`` is told by the file name unless it is given. An archive that
    does not exist raises; one that is damaged, or has no such member, closes the gate and says why. Rows that
    break a rule go to the quarantine. Repeating a load that was cut short takes up the members and files
    that are complete.
    """
    work, archive = work.rstrip("/"), qualified(spark, archive)
    if not exists(spark, archive):
        raise FileNotFoundError(archive)
    extract = archives.extract if whole else archives.extract_largest
    extract(spark.createDataFrame([(archive,)], "path string"), f"{work}/csv").write.mode("overwrite").parquet(f"{work}/manifest")
    members = spark.read.parquet(f"{work}/manifest")
    named = members.withColumn("layout", F.lit(layout) if layout else layouts.layout_of(F.coalesce("out_path", "member")))
    units: dict[str, list[str]] = {}
    report = []
    for row in sorted(named.collect(), key=lambda r: (r["member"] or "", r["out_path"] or "")):  # one short row per member
        found, unit = _member(spark, row, f"{work}/staging")
        report.append(found)
        if unit:
            units.setdefault(row["layout"], []).append(unit)
    done = sum(r["staged"] + r["rejected"] for r in report)
    if expected is not None and done != expected:
        report = [r | {"status": "lost rows" if r["status"] == "ok" else r["status"],
                       "error": r["error"] or f"{expected} records expected, {done} found"} for r in report]
    aside, tables = spark.createDataFrame([], quarantine.COLUMNS), {}
    for kind, paths in units.items():
        rows = staged_units(spark, kind, paths)
        aside = aside.unionByName(quarantine.quarantined(rows, kind, run_id))
        tables[kind] = rows.where("sound").drop(*EXTRA)
    names = [field.split()[0] for field in REPORT.split(", ")]
    frame = spark.createDataFrame([tuple(r[n] for n in names) for r in report], REPORT)
    return Loaded(tables, aside, frame, bool(report) and all(r["status"] == "ok" for r in report))


def _member(spark: SparkSession, row: Row, staging: str) -> tuple[dict, str | None]:
    """The report row of one extracted member, and the unit it is staged as."""
    out = {
        "archive": row["archive"], "member": row["member"], "file": (row["out_path"] or "").rpartition("/")[2] or None, "layout": row["layout"],
        "counted": 0, "read": 0, "staged": 0, "rejected": 0, "status": "ok", "error": row["error"],
    }
    if row["status"] not in ("extracted", "exists"):
        return out | {"status": row["status"]}, None
    if row["layout"] not in layouts.TABLES:
        return out | {"status": "unknown layout"}, None
    if not row["bytes"]:  # listings leave empty files out
        return out, None
    try:
        file = list_files(spark, literal(row["out_path"])).first()
        known = row if row["status"] == "extracted" else contents(spark.createDataFrame([(file["path"], file["length"])], "path string, length long")).first()
        facts = Facts.of(known)
        if facts.error:
            return out | {"status": "failed", "error": facts.error}, None
        counted = delimited.count_records(spark, [file["path"]], facts.multiline)
        unit = stage_file(spark, row["layout"], file, facts, f"{staging}/{row['layout']}")
        kept = staged_units(spark, row["layout"], [unit]).agg(F.count(F.lit(1)).alias("rows"), F.count_if("sound").alias("sound")).first()
    except Exception as error:  # told in the report, and the gate closes
        return out | {"status": "failed", "error": f"{type(error).__name__}: {error}"}, None
    out |= {"counted": counted, "read": kept["rows"], "staged": kept["sound"], "rejected": kept["rows"] - kept["sound"]}
    if counted != kept["rows"]:
        out |= {"status": "lost rows", "error": f"{counted} records counted, {kept['rows']} read"}
    return out, unit


def together(loads: list[Loaded]) -> dict[str, DataFrame]:
    """The staged tables of several loads, layout by layout."""
    kinds = sorted({kind for load in loads for kind in load.tables})
    return {kind: reduce(DataFrame.unionByName, [load.tables[kind] for load in loads if kind in load.tables]) for kind in kinds}
