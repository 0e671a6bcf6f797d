"""File listings, and opening a file from inside a task on any shared file system."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a Spark path (``file:``, ``hdfs:``, ``s3a:`` ...)."""
    local = re.sub(r"^file:/*", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system Spark would take, so that tasks do not take a bare path for their own disk.

    On a cluster a local target is refused: each task would write to its own machine.
    """
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toString()
    if whole.startswith("file:") and context.master.split("[")[0] not in ("local", "local-cluster"):
        raise ValueError(f"{path} is on the machine's own disk; name a folder all executors share")
    return whole


def literal(path: str) -> str:
    """A listed path for a reader that would take ``[``, ``{``, ``*`` or ``?`` as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, suffix: str = "", limit: int | None = None) -> DataFrame:
    """``path, name, length, modified`` of the files whose name ends in ``suffix`` (any case).

    Listing only: without ``content`` the reader opens no file. ``limit`` keeps
    the first files by name.
    """
    listed = (
        spark.read.format("binaryFile").load(folder)
        .select(
            "path", F.element_at(F.split("path", "/"), -1).alias("name"),
            "length", F.col("modificationTime").alias("modified"),
        )
        .where(F.endswith(F.lower("name"), F.lit(suffix.lower())))
    )
    return listed if limit is None else listed.orderBy("name").limit(limit)


def inventory(spark: SparkSession, folder: str, suffix: str = ".zip") -> DataFrame:
    """``name, size_mb, modified`` of the archives in a folder."""
    return list_files(spark, folder, suffix).select(
        "name", (F.col("length") / 1048576).alias("size_mb"), "modified"
    )


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows that each stand for a file, dealt out so that few share a task."""
    return df.repartition(tasks or 4 * df.sparkSession.sparkContext.defaultParallelism)
