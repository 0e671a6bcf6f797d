"""Incremental intake: archives not seen before are expanded, the rest skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.archives import extract

LISTING = "path string, modificationTime timestamp, length long, content binary"


def start_intake(
    spark: SparkSession, folder: str, target: str, manifest: str, checkpoint: str
) -> StreamingQuery:
    """Expands the archives that arrived since the last run, then stops.

    The checkpoint remembers which files were seen; only their listing is read.
    Each batch stores its own part of the manifest, so a repeated batch replaces
    its part instead of adding to it.
    """
    arrived = (
        spark.readStream.format("binaryFile").schema(LISTING).load(folder)
        .select("path").where(F.endswith(F.lower("path"), F.lit(".zip")))
    )

    def expand_batch(batch: DataFrame, batch_id: int) -> None:
        extract(batch, target).write.mode("overwrite").parquet(f"{manifest.rstrip('/')}/batch={batch_id}")

    return (
        arrived.writeStream.foreachBatch(expand_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
