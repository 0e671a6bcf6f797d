"""Exact dedup: sorted digest runs merged up a tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import one_of_each

KEY = ["digest", "n_bytes", "check"]


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id, SHA-256, length and a second hash of every text; null counts as empty."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.xxhash64(body).alias("check"),
    )


def _digit(number: Column, level: int, bits: int) -> Column:
    return F.shiftright(number, level * bits).bitwiseAND((1 << bits) - 1)


def tree_levels(partitions: int, bits: int) -> int:
    """Rounds after which there is a node for each of ``partitions``."""
    return max(1, -(-math.ceil(math.log2(max(partitions, 2))) // bits))


def merged_runs(rows: DataFrame, keep: str = "max", levels: int | None = None, bits: int = 4) -> DataFrame:
    """One row per distinct text: its key, the id that stays and the number of rows.

    There are ``2**(bits * levels)`` nodes, one for each shuffle partition unless ``levels`` says otherwise, and
    each stands for a part of the input. A keyed aggregation first combines the copies within a part, so a run holds a digest
    once, however often it occurs. From the first round on the run of node ``k`` is partition ``k``. In round ``r`` the ``2**bits`` nodes that differ only in digit ``r`` of
    their number are partners and exchange slices of their runs (with ``bits=1`` the pairs of a
    binomial exchange): a row goes to the partner whose digit ``r`` equals digit ``r`` of its digest.
    Rows move by node alone, so a run lies in one place; it is sorted by key there and equal digests,
    one from each partner at most, are merged in that order. After the last round equal digests are in one node.
    Digest, length and second hash are compared at every merge; the record with the wanted id survives.
    """
    if levels is None:
        levels = tree_levels(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), bits)
    nodes, best = 1 << (levels * bits), F.max if keep == "max" else F.min
    slot = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    leaf = F.pmod(F.spark_partition_id(), F.lit(nodes)).cast("int")
    runs = (
        rows.select(leaf.alias("node"), *KEY, F.struct("doc_id").alias("best"), F.lit(1).cast("long").alias("n"))
        .groupBy("node", *KEY).agg(best("best").alias("best"), F.sum("n").alias("n"))
    )
    for level in range(levels):
        mask = ((1 << bits) - 1) << (level * bits)
        moved = F.col("node").bitwiseAND(~mask) + F.shiftleft(_digit(slot, level, bits), level * bits)
        runs = (
            runs.withColumn("node", moved.cast("int")).repartitionById(nodes, "node").sortWithinPartitions("node", *KEY)
            .groupBy("node", *KEY).agg(best("best").alias("best"), F.sum("n").alias("n"))
        )
    return runs.select(*KEY, F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame, keep: str = "max", levels: int | None = None, bits: int = 4) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Only the id and the text are read, so extra columns of any name do no harm. Null
    texts and empty texts are equal. Rows without an id never replace one that has an id
    (``max`` and ``min`` put nulls aside by the order below); a group without any id has a
    null keep_id and all its rows stay. Rows that repeat an id with the same text are one
    document: they stay or go together, and each counts in group_size. An empty table
    gives an empty result.
    """
    rows = digests(docs)
    missing = F.lit(-(2**63) if keep == "max" else 2**63 - 1).cast("long")
    filled = rows.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), missing))
    groups = merged_runs(filled, keep, levels, bits).withColumn("keep_id", F.nullif("keep_id", missing))
    return rows.join(groups, KEY).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, keep: str = "max", reread: bool = False) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest (smallest) id; columns as they are.

    Null texts equal empty ones. Of rows that repeat id and text one stays, a row without an id only if
    its group has none with one. An empty table stays empty.
    If ``docs`` may be read again (``reread``) and its ids tell its rows apart, they are not stored first.
    """
    return one_of_each(docs, lambda rows: exact_dedup(rows, keep), "keep_id", largest=keep == "max", reread=reread)


ORACLE = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id is not distinct from max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""
