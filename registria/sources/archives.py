"""ZIP archives: members, extraction, and the choice of the main member.

Python workers run only here and where bytes are looked at (``content``), since Spark reads no ZIP.
Bytes stream from archive to target in chunks; no file is ever held in memory.
"""

from __future__ import annotations

import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import anti_join
from .content import Content
from .files import list_files, qualified, resolve, spread

CHUNK = 1024 * 1024
# What a damaged or unreadable archive raises; ArrowInvalid if it is too short for the trailer.
# Storage errors are left to Spark's task retry.
DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, pa.ArrowInvalid)
MEMBERS = "archive string, position long, member string, bytes long, valid boolean, error string"
RESULTS = (
    "archive string, member string, out_path string, bytes long, status string, error string,"
    " encoding string, multiline boolean, unterminated boolean"
)


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["path"]:
            try:
                system, inner = resolve(path)
                with system.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                    rows += [
                        (path, i, info.filename, info.file_size, True, None)
                        for i, info in enumerate(archive.infolist()) if not info.is_dir()
                    ]
            except DAMAGE as error:
                rows.append((path, None, None, None, False, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(rows, columns=["archive", "position", "member", "bytes", "valid", "error"]).astype(
            {"position": "Int64", "bytes": "Int64"}
        )


def members(archives: DataFrame) -> DataFrame:
    """One row per member of each archive; an unreadable archive is one row with ``valid`` false.

    Reads the tables of contents only, one archive at a time.
    """
    return spread(archives.select("path")).mapInPandas(_read_members, MEMBERS)


def _stem(archive):
    return F.regexp_replace(F.element_at(F.split(archive, "/"), -1), r"(?i)\.zip$", "")


def with_targets(listed: DataFrame, target: str) -> DataFrame:
    """Adds ``out_path``, ``{archive stem}_{member name}.csv`` under ``target``.

    Of members that would share a name the first keeps it; the others get a hash of
    archive and position before the base name, so every member has a file of its own.
    """
    folder, base = F.lit(target.rstrip("/") + "/"), F.concat(F.element_at(F.split("member", "/"), -1), F.lit(".csv"))
    own = F.sha2(F.concat_ws("\n", "archive", F.col("position").cast("string")), 256)
    named = listed.where("valid").withColumn("out_path", F.concat(folder, _stem("archive"), F.lit("_"), base))
    first = named.groupBy("out_path").agg(F.min(F.struct("archive", "position")).alias("_first"))
    apart = F.concat(folder, _stem("archive"), F.lit("_"), F.substring(own, 1, 16), F.lit("_"), base)
    return named.join(first, "out_path").select(
        "archive", "position", "member", "bytes",
        F.when(F.struct("archive", "position") == F.col("_first"), F.col("out_path")).otherwise(apart).alias("out_path"),
    )


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for archive, position, member, size, out_path in batch[["archive", "position", "member", "bytes", "out_path"]].itertuples(index=False):
            try:
                status, seen = _copy(archive, int(position), out_path)
                facts = (seen.encoding, seen.multiline, seen.unterminated) if seen else (None, None, None)
                rows.append((archive, member, out_path, size, status, None, *facts))
            except DAMAGE as error:
                rows.append((archive, member, out_path, size, "failed", f"{type(error).__name__}: {error}", None, None, None))
        yield pd.DataFrame(rows, columns=[
            "archive", "member", "out_path", "bytes", "status", "error", "encoding", "multiline", "unterminated",
        ]).astype({"multiline": "boolean", "unterminated": "boolean"})


def _copy(archive: str, position: int, out_path: str) -> tuple[str, Content | None]:
    """Copies a member verbatim and notes its encoding and quotes on the way.

    The name appears only when the file is complete, so a lost or repeated task
    leaves nothing half-written.
    """
    target, out = resolve(out_path)
    if target.get_file_info(out).is_file:
        return "exists", None
    seen = Content()
    part = f"{out}.{uuid.uuid4().hex}.part"
    source, inner = resolve(archive)
    try:
        with source.open_input_file(inner) as raw, zipfile.ZipFile(raw) as opened:
            with opened.open(opened.infolist()[position]) as src, target.open_output_stream(part) as dst:
                while chunk := src.read(CHUNK):
                    seen += Content.of(chunk)
                    dst.write(chunk)
        target.move(part, out)
    finally:  # whatever the error, no part stays behind
        if target.get_file_info(part).is_file:
            target.delete_file(part)
    return "extracted", seen


def extract(archives: DataFrame, target: str) -> DataFrame:
    """``archive, member, out_path, bytes, status, error, encoding, multiline, unterminated``
    after extracting every member.

    One task per member rather than per archive. Running the result does the
    work: store it once instead of reading it twice. A member extracted before
    is ``exists``, an unreadable archive ``corrupt``. The last three columns tell the encoding and whether
    a quoted value spans lines or never ends, so loading needs no pass to find out.
    """
    listed, target = members(archives), qualified(archives.sparkSession, target)
    return _copied(with_targets(listed, target), target).unionByName(_unread(listed, ~F.col("valid"), "corrupt"))


def extract_largest(archives: DataFrame, target: str) -> DataFrame:
    """As ``extract``, but only the largest CSV-like member of each archive, named as
    ``largest_member`` says. An archive without such a member is ``no csv member``."""
    listed, target = members(archives), qualified(archives.sparkSession, target)
    picked = largest_member(listed)
    out_path = F.concat(F.lit(target.rstrip("/") + "/"), F.col("out_name"))
    without = anti_join(listed, picked, "archive").where(~F.col("valid") | (F.col("position") == 0))
    return (
        _copied(picked.withColumn("out_path", out_path), target)
        .unionByName(_unread(without, ~F.col("valid"), "corrupt"))
        .unionByName(_unread(without, F.col("valid"), "no csv member"))
    )


def _copied(targets: DataFrame, target: str) -> DataFrame:
    system, inner = resolve(target)
    system.create_dir(inner, recursive=True)
    return spread(targets).mapInPandas(_extract, RESULTS)


def _unread(listed: DataFrame, which: Column, status: str) -> DataFrame:
    return listed.where(which).select(
        "archive", "member", F.lit(None).cast("string").alias("out_path"), "bytes",
        F.lit(status).alias("status"), "error", F.lit(None).cast("string").alias("encoding"),
        F.lit(None).cast("boolean").alias("multiline"), F.lit(None).cast("boolean").alias("unterminated"),
    )


def expand(spark: SparkSession, folder: str, target: str, manifest: str, limit: int | None = None) -> DataFrame:
    """Extracts the folder's archives and returns the manifest stored at ``manifest``."""
    extract(list_files(spark, folder, ".zip", limit), target).write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(manifest)


def largest_member(listed: DataFrame) -> DataFrame:
    """Per valid archive its largest CSV-like member: ``archive, position, member, bytes, out_name``."""
    name = F.lower("member")
    pick = (
        listed.where("valid").where(F.endswith(name, F.lit(".csv")) | F.contains(name, F.lit("estabele")))
        .groupBy("archive")
        .agg(F.max_by(F.struct("position", "member", "bytes"), F.struct("bytes", F.negative("position"))).alias("m"))
        .select("archive", "m.*")
    )
    base = F.element_at(F.split("member", "/"), -1)
    named = F.when(F.contains(base, F.lit(".")), base).otherwise(F.concat(base, F.lit(".csv")))
    return pick.withColumn("out_name", F.concat(_stem("archive"), F.lit("__"), named))
