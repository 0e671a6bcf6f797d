"""Versions of the published tables: one pointer for all tables of a run, moved in one step.

Each version is a small file ``versions/<number>.json`` under the published root that names the folder
of every table. It appears by a rename, so readers see the version before or this one, and never
tables of both. Data folders are written once and never again.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RUNS = "_runs"  # the database of the tables that views point at
ATTEMPTS = 10


class Conflict(RuntimeError):
    """Another run published at the same time, again and again."""


@dataclass(frozen=True)
class Version:
    number: int
    run_id: str
    tables: dict[str, str] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table as of this version, whatever is published meanwhile."""
        return spark.read.parquet(self.tables[name])


def files_of(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/versions"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The versions there are, oldest first."""
    system, place = files_of(spark, _log(root))
    if not system.exists(place):
        return []
    names = (status.getPath().getName() for status in system.listStatus(place))
    return sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d{20}\.json", name))


def read(spark: SparkSession, root: str, number: int) -> Version:
    system, place = files_of(spark, f"{_log(root)}/{number:020d}.json")
    stream = system.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def current(spark: SparkSession, root: str) -> Version | None:
    known = numbers(spark, root)
    return read(spark, root, known[-1]) if known else None


def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, str], whole: bool = False) -> Version:
    """A new version with ``tables`` in place of those of the same name; others stay as they are.

    ``whole`` leaves the others out. Of two runs that publish at once the second to rename
    finds its number taken and goes on from the other's version.
    """
    system, log = files_of(spark, _log(root))
    system.mkdirs(log)
    for _ in range(ATTEMPTS):
        before = current(spark, root) or Version(0, "")
        version = Version(before.number + 1, run_id, tables if whole else before.tables | tables)
        _, part = files_of(spark, f"{_log(root)}/{uuid.uuid4().hex}.part")
        _, final = files_of(spark, f"{_log(root)}/{version.number:020d}.json")
        out = system.create(part, False)
        out.write(bytearray(json.dumps(version.__dict__).encode()))
        out.close()
        if not system.exists(final) and system.rename(part, final):
            return version
        system.delete(part, False)
    raise Conflict(f"no number left for run {run_id} after {ATTEMPTS} attempts")


def restore(spark: SparkSession, root: str, number: int) -> Version:
    """Makes the tables of an earlier version current again, as a version of its own."""
    earlier = read(spark, root, number)
    return publish(spark, root, earlier.run_id, earlier.tables, whole=True)


def run_table(database: str, name: str, path: str) -> str:
    return f"`{database}{RUNS}`.`{name}_{re.sub(r'[^A-Za-z0-9]+', '_', path.rstrip('/').rsplit('/', 1)[-1])}`"


def register(spark: SparkSession, database: str, name: str, path: str) -> str:
    """A catalog table over one run's folder, with statistics; it never changes."""
    spark.sql(f"create database if not exists `{database}{RUNS}`")
    table, location = run_table(database, name, path), path.replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"create table if not exists {table} ({columns}) using parquet location '{location}'")
    spark.sql(f"analyze table {table} compute statistics")
    return table


def show(spark: SparkSession, database: str, version: Version) -> None:
    """Views ``database.name`` on the tables of ``version``; each is replaced in one catalog change, whatever its columns.

    For readers by name. They may see two versions while views are replaced one by one; readers that
    join tables take a ``Version`` (or ``mount`` it). Repeating it finishes what a lost driver left. A plain table
    of that name, left by an earlier release, makes way once.
    """
    spark.sql(f"create database if not exists `{database}`")
    for name, path in version.tables.items():
        known = f"{database}.{name}"
        if spark.catalog.tableExists(known) and spark.catalog.getTable(known).tableType != "VIEW":
            spark.sql(f"drop table `{database}`.`{name}`")
        table = register(spark, database, name, path)
        spark.sql(f"create or replace view `{database}`.`{name}` as select * from {table}")


def mount(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """Temporary views of this session on all tables of one version, the current one if none is named."""
    version = current(spark, root) if number is None else read(spark, root, number)
    if version is None:
        raise ValueError(f"nothing is published under {root}")
    for name in version.tables:
        version.table(spark, name).createOrReplaceTempView(name)
    return version


def expire(spark: SparkSession, root: str, database: str, keep: int = 2) -> list[str]:
    """Deletes folders and catalog tables that none of the last ``keep`` versions names; returns the folders.

    For times without readers of older versions. Folders go before the versions that name
    them, so a run that is cut short can be repeated.
    """
    known = [read(spark, root, n) for n in numbers(spark, root)]
    old, held = known[:-keep] if keep else [], {p for v in known[-keep:] for p in v.tables.values()}
    gone = sorted({(name, p) for v in old for name, p in v.tables.items() if p not in held})
    for name, path in gone:
        spark.sql(f"drop table if exists {run_table(database, name, path)}")
        system, place = files_of(spark, path)
        system.delete(place, True)
    for version in old:
        system, place = files_of(spark, f"{_log(root)}/{version.number:020d}.json")
        system.delete(place, False)
    return [path for _, path in gone]
