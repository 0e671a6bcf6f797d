"""Sharding: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import ROWS_PER_BUCKET, hex_bucket, running, shuffle_key, source_key, stored


def interleaved_shards(docs: DataFrame, shards: int = 24, seed: str = "shards", extra: dict | None = None) -> DataFrame:
    """Every row's shard and slot; shards differ by one row at most and all hold the mixture.

    Rows of a source are ranked in a seeded shuffle (md5 of the id). Row ``r`` of the ``n``
    rows of its source gets the fractional rank ``(r + phase) / n``; sorted by it, ties by
    source and shuffle, every stretch of the order holds each source in proportion. The
    phase, from 0 to 1, is drawn from the source's name, lest many sources of one size
    come in step. The order is cut into ``shards`` stretches of equal counts.

    Nothing is gathered: ranks come from buckets of the shuffle, and the position in the
    order from buckets of the fractional rank, which fill evenly by construction. Text
    stays where it is; only id, source and the ``extra`` measures are shuffled.

    Null sources are a source of their own (the last); null ids sort as the text
    "null"; rows that repeat an id are ranked one after the other. Returns doc_id, source_key,
    shard, slot (gapless from 0) and the extras; an empty table gives an empty result.
    """
    measures = dict(extra or {})
    lean = stored(
        docs.select(
            F.col("doc_id"), source_key(F.col("source")).alias("source_key"),
            shuffle_key(seed, F.col("doc_id")).alias("mix"),
            *[e.alias(k) for k, e in measures.items()],
        ),
        "shard-rows",
    )
    rows = lean.count()
    ties = ["mix", "doc_id", *measures]
    ranked = running(lean, "source_key", hex_bucket("mix", rows), ties, F.lit(1), "rank")
    counts = lean.groupBy("source_key").agg(F.count(F.lit(1)).alias("of"))
    phase = F.conv(F.substring(shuffle_key(seed, F.col("source_key")), 1, 4), 16, 10).cast("long")
    step = F.lit(65536).cast("decimal(6,0)")
    upto = F.col("rank").cast("decimal(20,0)") * step + phase.cast("decimal(6,0)")
    placed = stored(
        ranked.join(counts, "source_key").withColumn("frac", (upto / (F.col("of").cast("decimal(20,0)") * step)).cast("decimal(38,18)")),
        "shard-ranks",
    )
    buckets = max(1, rows // ROWS_PER_BUCKET)
    cut = placed.withColumn("_b", F.floor(F.col("frac") * buckets).cast("long"))
    sums = cut.groupBy("_b").agg(F.count(F.lit(1)).alias("_t")).withColumn("_g", F.floor(F.col("_b") / 1024).cast("long"))
    earlier = (Window.unboundedPreceding, -1)
    far = (
        sums.groupBy("_g").agg(F.sum("_t").alias("_gt"))
        .withColumn("_goff", F.coalesce(F.sum("_gt").over(Window.orderBy("_g").rowsBetween(*earlier)), F.lit(0)))
        .select("_g", "_goff")
    )
    near = sums.withColumn("_o", F.coalesce(F.sum("_t").over(Window.partitionBy("_g").orderBy("_b").rowsBetween(*earlier)), F.lit(0)))
    offsets = near.join(far, "_g").select("_b", (F.col("_o") + F.col("_goff")).alias("_off"))
    at = F.row_number().over(Window.partitionBy("_b").orderBy("frac", "source_key", *ties)) - 1
    placed_at = cut.withColumn("_at", at).join(offsets, "_b").withColumn("pos", (F.col("_at") + F.col("_off")).cast("long"))
    # shard j holds the positions from ceil(j n / k) up to ceil((j + 1) n / k)
    shard = F.expr(f"pos * {shards} div {max(rows, 1)}")
    begin = F.expr(f"((pos * {shards} div {max(rows, 1)}) * {rows} + {shards - 1}) div {shards}")
    return placed_at.select(
        "doc_id", "source_key", *measures, shard.cast("int").alias("shard"), (F.col("pos") - begin).alias("slot"),
    )


def shard_digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The report of a sharding: sizes, checksums, law, shard and slot of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = interleaved_shards(
        docs, shards,
        extra={"size": F.octet_length(text).cast("long") + 8, "text_crc32": F.crc32(text.cast("binary")).cast("long")},
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
