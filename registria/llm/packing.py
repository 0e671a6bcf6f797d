"""Mixture-controlled packing: deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import source_key, stored
from .tokens import Encoder, stretches

QUEUES = 4096
FRACTION = 16  # bits of a quantum below one token
TOKENS = "part int, source_key string, doc_id long, at long, n long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
          " offset long, window long, source_key string")


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Packed ids of every document and where it begins in its task's part of its source."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path), np.array([end_id], dtype="<u2").tobytes()
        part, filled = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for first, texts in stretches(batch.column(1)):
                sources = batch.column(2).slice(first, len(texts))
                ids, at = encoder.packed(texts, end), []
                n = pc.binary_length(ids).to_numpy() // 2
                for source, size in zip(sources.to_pylist(), n.tolist()):
                    at.append(filled[source])
                    filled[source] += size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(texts), pa.int32()), sources.cast(pa.string()),
                        batch.column(0).slice(first, len(texts)),
                        pa.array(at, pa.int64()), pa.array(n, pa.int64()), ids,
                    ],
                    ["part", "source_key", "doc_id", "at", "n", "ids"],
                )

    lean = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        source_key(F.col("source")).alias("source_key"),
    )
    return lean.mapInArrow(encode, TOKENS)


class RoundRobin:
    """Closed form of the rounds: how much each queue has given after any window.

    Every window adds a quantum to the credit of every queue, and a queue gives whole tokens
    up to its credit: after ``k`` windows it has given ``min(total, floor(k * quantum))``. What
    is left of the credit is the deficit that the next window starts with.
    """

    def __init__(self, totals: np.ndarray, quanta: np.ndarray):
        self.totals, self.quanta = totals, quanta
        self.last = -((-totals << FRACTION) // quanta)  # the window in which a queue runs out
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def given(self, window: int) -> np.ndarray:
        return np.minimum(self.totals, np.minimum(window, self.last) * self.quanta >> FRACTION)

    def window_of(self, queue: int, token: int) -> int:
        """The window, from 1, that takes a queue's token."""
        return -(-((token + 1) << FRACTION) // int(self.quanta[queue]))

    def layout(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """What each queue has given before the window, and where its share begins in the stream."""
        if window not in self.seen:
            if len(self.seen) > 64:
                self.seen.clear()
            before, after = self.given(window - 1), self.given(window)
            share = after - before
            self.seen[window] = before, int(before.sum()) + np.cumsum(share) - share
        return self.seen[window]

    def runs(self, queue: int, begin: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(window, first token, one past the last, place in the stream) of a stretch of a queue."""
        while begin < end:
            window = self.window_of(queue, begin)
            before, places = self.layout(window)
            stop = min(end, int(self.given(window)[queue]))
            yield window, begin, stop, int(places[queue]) + begin - int(before[queue])
            begin = stop


def pack(docs: DataFrame, path: str, length: int = 2048, window: int = 131072, end_id: int = 1,
         weights: dict | None = None) -> DataFrame:
    """Packs all documents into sequences of ``length`` tokens; one row per piece.

    Sources are queues in order of arrival (task, then row). A window of about ``window``
    tokens takes from each queue its quantum: by default the queue's share of all tokens, so
    that the mixture holds from the first window to the last, or a share by ``weights`` (source
    to weight; sources not named weigh 1), where queues that run out leave the rest to the others.
    Windows follow each other in one stream, cut every ``length`` tokens, so that only the very
    last sequence is padded. Documents are cut at window and sequence ends.

    Texts are encoded once. The ids stay where they are stored: a piece's place follows from
    the totals of the queues and from where its task's part of the queue begins. More than
    4096 sources share 4096 queues, which bounds what tasks are sent.

    A null or empty text is the end id alone; null sources are one source; repeated rows are
    packed each; an empty table gives no piece. Only doc_id, text and source are read.
    """
    if np.iinfo("<u2").max < end_id:
        raise ValueError("ids are kept in 16 bits")
    rows = stored(tokenized(docs, path, end_id), "pack-tokens")
    parts = rows.groupBy("part", "source_key").agg(F.sum("n").alias("tokens"))
    names = rows.groupBy("source_key").agg(F.sum("n").alias("_all")).withColumn(
        "queue", ((F.row_number().over(Window.orderBy("source_key")) - 1) % QUEUES).cast("int")
    ).drop("_all")
    places = stored(
        parts.join(names, "source_key").withColumn("queue_at", F.coalesce(
            F.sum("tokens").over(Window.partitionBy("queue").orderBy("part", "source_key")
                                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "pack-places",
    )
    share = F.lit(None).cast("double")
    for name, weight in (weights or {}).items():
        share = F.when(F.col("source_key") == (("0" + name) if name is not None else "1"), F.lit(float(weight))).otherwise(share)
    sums = places.groupBy("queue").agg(
        F.sum("tokens").alias("tokens"), F.max(F.coalesce(share, F.lit(1.0))).alias("weight")
    ).orderBy("queue").collect()  # at most 4096 rows
    totals = np.array([r["tokens"] for r in sums], dtype=np.int64)
    wanted = np.array([r["weight"] for r in sums]) if weights else totals.astype(float)
    quanta = np.maximum(1, np.floor(window * (1 << FRACTION) * wanted / max(wanted.sum(), 1))).astype(np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        robin = RoundRobin(totals, quanta)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, queue, source, at, n, ids in zip(*[c.to_pylist() for c in batch.columns]):
                wide = np.frombuffer(ids, dtype="<u2").astype("<u4")
                for k, begin, end, place in robin.runs(queue, at, at + n):
                    while begin < end:
                        size = min(end - begin, length - place % length)
                        start = begin - at
                        out.append((doc_id, start, size, zlib.crc32(wide[start:start + size]), n,
                                    place // length, place % length, k, source))
                        begin, place = begin + size, place + size
            columns = list(zip(*out)) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i == 8 else pa.int64()) for i, c in enumerate(columns)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "source_key"],
            )

    placed = rows.join(places.drop("tokens"), ["part", "source_key"]).select(
        "doc_id", "queue", "source_key", (F.col("at") + F.col("queue_at")).alias("at"), "n", "ids"
    )
    return placed.mapInArrow(cut, PIECES)


