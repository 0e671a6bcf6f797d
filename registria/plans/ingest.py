"""The monthly run: expand archives, stage their files, publish if all is well."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from ..sources import archives, delimited, layouts
from ..sources.content import contents
from ..sources.files import list_files, literal
from . import quarantine
from .publish import promote

# Text bytes of the fact per published file; as parquet about a quarter of that.
FACT_PARTITION_BYTES = 512 * 1024 * 1024
REPORT = "file string, layout string, read long, rows long, rejected long, status string, error string"


@dataclass
class Staged:
    """Staged rows per layout, rows set aside, the per-file report, the gate, and the quarantine table."""

    tables: dict[str, DataFrame]
    rejected: dict[str, DataFrame]
    report: DataFrame
    ok: bool
    quarantine: DataFrame


class Run(NamedTuple):
    manifest: DataFrame
    report: DataFrame
    done: DataFrame
    quarantine: DataFrame


class Facts(NamedTuple):
    """What is known of a file before it is read; ``error`` if it cannot be."""

    encoding: str | None
    multiline: bool
    error: str | None

    @classmethod
    def of(cls, row: Row) -> Facts:
        error = row["error"] or ("a quoted value never ends" if row["unterminated"] else None)
        return cls(row["encoding"], bool(row["multiline"]), error)


def marked_rows(spark: SparkSession, layout: str, profile: list[tuple[str, str, bool]]) -> DataFrame:
    """Rows of files of a layout with the ``reasons`` each fails, if any, and whether it is ``sound``."""
    rows = delimited.read_files(spark, layout, profile)
    reasons = quarantine.reasons_of(layout, F.col(delimited.CORRUPT).isNotNull())
    return rows.withColumn("reasons", reasons).withColumn("sound", F.size("reasons") == 0)


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def stage_file(spark: SparkSession, layout: str, file: Row, facts: Facts, folder: str) -> str:
    """Stores the marked rows of one file as a unit of its own under ``folder`` and returns its path.

    A unit is named after the file's path, size and time and what is known of it: one that is complete is not
    staged again, one that failed or whose file has changed is. Sound and failing rows go to
    separate partitions, so later reads of either skip the other.
    """
    identity = (file["path"], file["length"], file["modified"], *facts)
    path = f"{folder}/unit={hashlib.sha256(repr(identity).encode()).hexdigest()[:16]}"
    if not exists(spark, f"{path}/_SUCCESS"):
        marked_rows(spark, layout, [(file["path"], facts.encoding, facts.multiline)]).write.mode("overwrite").partitionBy("sound").parquet(path)
    return path


def _facts(spark: SparkSession, files: list[Row], manifest: DataFrame | None) -> dict[str, Facts]:
    """Facts by file name: from the manifest where extraction noted them, else from the bytes."""
    known = {}
    if manifest is not None:
        extracted = manifest.where("status = 'extracted'").withColumn("name", F.element_at(F.split("out_path", "/"), -1))
        known = {r["name"]: Facts.of(r) for r in extracted.select("name", "encoding", "multiline", "unterminated", "error").collect()}
    names = {r["path"]: r["name"] for r in files if r["name"] not in known}
    if names:
        unseen = spark.createDataFrame([(r["path"], r["length"]) for r in files if r["path"] in names], "path string, length long")
        known |= {names[r["path"]]: Facts.of(r) for r in contents(unseen).collect()}
    return known


def _forgotten(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table):  # catalog entries only; files stay
        kind = "view" if spark.catalog.getTable(table).tableType == "VIEW" else "table"
        spark.sql(f"drop {kind} {table}")


def load(
    spark: SparkSession, folder: str, staging: str, limit_files: int | None = None,
    allow_unknown: bool = False, strict: bool = False, database: str = "staging",
    manifest: DataFrame | None = None, run_id: str = "", corrections: DataFrame | None = None, parallel: int = 8,
) -> Staged:
    """Stages every ``.csv`` of the folder by layout, each file by itself.

    A file of unknown layout or one that cannot be read clears the gate, but the
    others go on, ``parallel`` files at a time; so does finding no file. Repeating the load stages only
    files that failed or changed. Rows that break a rule are set aside in the quarantine table
    with reason and place, after ``corrections`` (``file, record, fields``) took their turn.
    ``strict`` clears the gate for those left, as a database that
    refuses the file would. ``manifest`` spares the pass over the bytes that finds encodings
    and line breaks in quotes. The report has one row per file; rows read are rows staged plus rows in quarantine,
    and a file where they are not clears the gate.
    """
    spark.sql(f"create database if not exists `{database}`")
    for layout in layouts.TABLES:
        _forgotten(spark, f"{database}.temp_{layout}")
    files = list_files(spark, folder, ".csv", limit_files).withColumn("layout", layouts.layout_of("name"))
    listed = files.orderBy("name").collect()  # one short row per file, not per record
    facts = _facts(spark, [r for r in listed if r["layout"] in layouts.TABLES], manifest)
    errors = {name: f.error for name, f in facts.items() if f.error}

    def staged_unit(file: Row) -> tuple[str, str, str | None]:
        try:
            return file["layout"], stage_file(spark, file["layout"], file, facts[file["name"]], f"{staging.rstrip('/')}/{file['layout']}"), None
        except Exception as error:  # the other files go on
            return file["layout"], file["name"], f"{type(error).__name__}: {error}"

    units: dict[str, list[str]] = {}
    with ThreadPoolExecutor(parallel) as pool:
        for layout, found, error in pool.map(staged_unit, [r for r in listed if r["layout"] in layouts.TABLES and r["name"] not in errors]):
            if error:
                errors[found] = error
            else:
                units.setdefault(layout, []).append(found)

    tables, rejected, counts = {}, {}, {}
    extra = [delimited.CORRUPT, delimited.SOURCE, *delimited.PLACE, "reasons", "sound"]
    for layout, paths in units.items():
        stored = staged_units(spark, layout, paths)
        per_file = stored.groupBy(delimited.SOURCE).agg(F.count(F.lit(1)).alias("rows"), F.count_if("sound").alias("sound"))
        counted = per_file.collect()
        counts |= {_listed(r[0]): (r["rows"], r["sound"]) for r in counted}
        tables[layout] = stored.where("sound").drop(*extra)
        rejected[layout] = stored.where(~F.col("sound")).drop("sound")
        if any(r["sound"] for r in counted):  # else there is no such partition
            names = ",".join(p.rsplit("/", 1)[1] for p in paths)
            source = f"{literal(staging.rstrip('/'))}/{layout}/{{{names}}}/sound=true"
            columns = ", ".join(f"`{c}`" for c in layouts.LAYOUTS[layout])
            spark.sql(f"create view `{database}`.`temp_{layout}` as select {columns} from parquet.`{source}`")
    aside, replayed = _set_aside(spark, units, run_id, staging.rstrip("/"), corrections)
    for layout, rows in replayed.items():
        tables[layout] = tables[layout].unionByName(rows.drop("file"))
    left = dict(aside.groupBy("file").count().collect())
    mended = dict(reduce(DataFrame.unionByName, [r.select("file") for r in replayed.values()]).groupBy("file").count().collect()) if replayed else {}

    report = []
    for file in listed:
        name, error = file["name"], errors.get(file["name"])
        read, sound = counts.get(_plain(file["path"]), (0, 0))
        rows, bad = sound + mended.get(name, 0), left.get(name, 0)
        if file["layout"] not in layouts.TABLES:
            status = "ok" if allow_unknown else "unknown layout"
        elif error:
            status = "failed"
        elif rows + bad != read:
            status = "lost rows"
        else:
            status = "rejected rows" if strict and bad else "ok"
        report.append((name, file["layout"], read, rows, bad, status, error))
    ok = bool(report) and all(r[5] == "ok" for r in report)
    return Staged(tables, rejected, spark.createDataFrame(report, REPORT), ok, aside)


def staged_units(spark: SparkSession, layout: str, units: list[str]) -> DataFrame:
    """The marked rows of staged units of a layout."""
    schema = delimited.staged_schema(layout).add("reasons", ArrayType(StringType())).add("sound", BooleanType()).add("unit", StringType())
    folder = units[0].rpartition("/")[0]
    return spark.read.schema(schema).option("basePath", folder).parquet(*[literal(u) for u in units]).drop("unit")


def _set_aside(
    spark: SparkSession, units: dict[str, list[str]], run_id: str, staging: str, corrections: DataFrame | None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The quarantine table, and by layout the rows that corrections made sound."""
    found = spark.createDataFrame([], quarantine.COLUMNS)
    for layout, paths in units.items():
        found = found.unionByName(quarantine.quarantined(staged_units(spark, layout, paths), layout, run_id))
    found = _written(spark, found, f"{staging}/quarantine/found")
    if corrections is None:
        return found, {}
    parts = {layout: quarantine.replay(found, corrections, layout) for layout in units}
    rests = reduce(DataFrame.unionByName, [rest for _, rest in parts.values()], spark.createDataFrame([], quarantine.COLUMNS))
    return _written(spark, rests, f"{staging}/quarantine/left"), {layout: sound for layout, (sound, _) in parts.items()}


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _plain(path: str) -> str:
    """One spelling of a path: listings write ``file:/x``, file metadata ``file:///x``."""
    return path.replace("file:///", "file:/")


def _listed(metadata_path: str) -> str:
    """A path of file metadata, where names are percent-encoded, as listings write it."""
    return _plain(unquote(metadata_path))


def run_ingest(
    spark: SparkSession, source: str, work: str, published: str, run_id: str,
    limit: int | None = None, allow_unknown: bool = False, strict: bool = False,
    fact_partitions: int | None = None, corrections: DataFrame | None = None, all_or_nothing: bool = False,
) -> Run:
    """Archives in ``source`` to published tables: manifest, load report, publish report, quarantine.

    Steps run in this order and each starts from what the one before stored.
    Repeating a ``run_id`` skips members already extracted and files already staged for it; a new one
    starts clean. The quarantine is published with the tables, and ``corrections`` of its rows
    (``file, record, fields``) make a repeated run publish them too. All folders must be reachable from
    every executor.
    """
    work = work.rstrip("/")
    csv = f"{work}/csv/{run_id}"
    manifest = archives.expand(spark, source, csv, f"{work}/manifest/{run_id}", limit)
    staged = load(
        spark, csv, f"{work}/staging/{run_id}", allow_unknown=allow_unknown, strict=strict,
        manifest=manifest, run_id=run_id, corrections=corrections,
    )
    if fact_partitions is None:
        of_fact = layouts.layout_of("out_path") == "estabelecimento"
        size = manifest.where(of_fact).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        fact_partitions = 1 + size // FACT_PARTITION_BYTES
    staged_tables = staged.tables | {"quarantine": staged.quarantine} if staged.tables else {}
    done = promote(spark, staged_tables, staged.ok, published, run_id, fact_partitions=fact_partitions, all_or_nothing=all_or_nothing)
    return Run(manifest, staged.report, done, staged.quarantine)
