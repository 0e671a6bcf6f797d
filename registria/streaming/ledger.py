"""Incremental intake through to published rows: a ledger of archives, each of which counts once.

An entry is a small file ``ledger/<archive key>.json`` under the published root that names the folders of one
archive's rows. It appears by a rename once they are complete, and the tables are the rows of all entries. So a batch that
is repeated, or a checkpoint that is lost, neither doubles nor skips an archive.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.publish import curated
from ..plans.single import load_archive
from ..plans.versions import files_of
from ..sources.files import list_files
from .intake import LISTING

QUARANTINE = "quarantine"
OUTCOME = "archive string, key string, status string, error string"


def archive_key(archive: Row) -> str:
    """An archive by path, size and time: one that is sent again with other bytes is another."""
    return hashlib.sha256(f"{archive['path']}\n{archive['length']}\n{archive['modified']}".encode()).hexdigest()[:24]


def entries(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """By archive key, the folders of its rows by table."""
    system, place = files_of(spark, f"{root.rstrip('/')}/ledger")
    if not system.exists(place):
        return {}
    found = {}
    for status in system.listStatus(place):
        if re.fullmatch(r"[0-9a-f]{24}\.json", status.getPath().getName()):
            stream = system.open(status.getPath())
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found[status.getPath().getName()[:24]] = json.loads(text)
    return found


def commit(spark: SparkSession, root: str, key: str, tables: dict[str, str]) -> bool:
    """Enters an archive; False if it was there already, and then nothing changes."""
    folder = f"{root.rstrip('/')}/ledger"
    system, place = files_of(spark, folder)
    system.mkdirs(place)
    _, part = files_of(spark, f"{folder}/{uuid.uuid4().hex}.part")
    _, final = files_of(spark, f"{folder}/{key}.json")
    out = system.create(part, False)
    out.write(bytearray(json.dumps(tables).encode()))
    out.close()
    if not system.exists(final) and system.rename(part, final):
        return True
    system.delete(part, False)
    return False


def table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table's rows of all entered archives, as of now; None while there are none."""
    paths = sorted(tables[name] for tables in entries(spark, root).values() if name in tables)
    return spark.read.parquet(*paths) if paths else None


def pending(spark: SparkSession, folder: str, root: str) -> list[Row]:
    """Archives of a folder that the ledger does not hold: new ones and those that failed."""
    known = entries(spark, root)
    return [a for a in list_files(spark, folder, ".zip").orderBy("path").collect() if archive_key(a) not in known]


def load_archives(spark: SparkSession, archives: list[Row], work: str, root: str, parallel: int = 4) -> DataFrame:
    """Loads archives (path, length, modified) not in the ledger: ``archive, key, status, error`` of each.

    An archive enters with all its members or not at all. Work folders are named after the archive, so a load that
    was cut short goes on where it stopped; rows are written to a new folder each time, which counts only once entered.
    """
    known, root = entries(spark, root), root.rstrip("/")

    def load(archive: Row) -> tuple[str, str, str, str | None]:
        key = archive_key(archive)
        if key in known:
            return archive["path"], key, "known", None
        try:
            loaded = load_archive(spark, archive["path"], f"{work.rstrip('/')}/{key}", whole=True, run_id=key)
            if not loaded.ok:
                bad = loaded.report.where("status <> 'ok'").orderBy("member").collect()
                return archive["path"], key, "failed", "; ".join(f"{r['member']}: {r['status']} {r['error'] or ''}".strip() for r in bad) or "no member"
            tables = {}
            for name, rows in loaded.tables.items():
                tables[name] = f"{root}/{name}/{key}-{uuid.uuid4().hex[:8]}"
                curated(name, rows).write.parquet(tables[name])
            if not loaded.quarantine.isEmpty():
                tables[QUARANTINE] = f"{root}/{QUARANTINE}/{key}-{uuid.uuid4().hex[:8]}"
                loaded.quarantine.write.parquet(tables[QUARANTINE])
            return archive["path"], key, "entered" if commit(spark, root, key, tables) else "known", None
        except Exception as error:  # the other archives go on; this one stays pending
            return archive["path"], key, "failed", f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(parallel) as pool:
        return spark.createDataFrame(list(pool.map(load, archives)), OUTCOME)


def start_loading(spark: SparkSession, folder: str, work: str, root: str, checkpoint: str) -> StreamingQuery:
    """Publishes the rows of the archives that arrived since the last run, then stops.

    The stream finds what is new; the ledger decides what counts. Outcomes are stored under ``outcomes/batch=<number>``.
    Failed archives stay ``pending`` and can be given to ``load_archives`` again.
    """
    arrived = (
        spark.readStream.format("binaryFile").schema(LISTING).load(folder)
        .select("path", "length", F.col("modificationTime").alias("modified")).where(F.endswith(F.lower("path"), F.lit(".zip")))
    )

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        done = load_archives(batch.sparkSession, batch.orderBy("path").collect(), work, root)  # a row per archive
        done.write.mode("overwrite").parquet(f"{root.rstrip('/')}/outcomes/batch={batch_id}")

    return (
        arrived.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
