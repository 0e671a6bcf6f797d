"""Token counts: overlapping chunks of huge documents, spliced where both agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tokens import Encoder, slices, units

SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_chunks long"
# A unit longer than this is looked into for boundaries.
LONG_UNIT = 64


def chunk_tokens(encoder: Encoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets at which pre-tokens begin in a chunk, and the number of ids up to the next one."""
    words, size = units(text), np.dtype(encoder.width).itemsize
    lengths = np.array([len(w) + 1 for w in words])
    lengths[0] -= 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    counts = np.array([len(p) // size for p in encoder.pieces(text)])
    long = np.flatnonzero(lengths > LONG_UNIT)
    if len(long):
        extra = [encoder.inside(text[starts[i]:starts[i] + lengths[i]]) for i in long]
        plain = np.setdiff1d(np.arange(len(words)), long)
        starts = np.concatenate([starts[plain], *[np.array(s, dtype=int) + starts[i] for i, (s, _) in zip(long, extra)]])
        counts = np.concatenate([counts[plain], *[np.array(c, dtype=int) for _, c in extra]])
        order = np.argsort(starts, kind="stable")
        starts, counts = starts[order], counts[order]
    return starts, counts


def spliced_count(encoder: Encoder, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """Ids of ``text`` and the chunks it took, never holding ids of more than a few chunks.

    Neighbouring chunks overlap. An offset at which a pre-token begins in both is a proven
    boundary: the scan keeps nothing from before, so the later chunk's ids are right from
    there on; and as it lies further from the earlier chunk's end than any lookahead or added
    token reaches, the earlier chunk's ids are right up to there. If the overlap holds no such
    offset it is doubled, and if it already covers the earlier chunk, that chunk is doubled.
    """
    added = encoder.tokenizer.get_added_tokens_decoder().values()
    margin = 2 + max([len(t.content) for t in added], default=0)
    total, cut, end, chunks = 0, 0, min(chunk, len(text)), 1
    starts, counts = chunk_tokens(encoder, text[:end])
    while end < len(text):
        wide, found = overlap, None
        while found is None:
            begin = max(cut, end - wide)
            stop = min(len(text), max(begin + chunk, end + chunk // 2 + 1))  # always further than before
            later, later_counts = chunk_tokens(encoder, text[begin:stop])
            chunks += 1
            both = np.intersect1d(starts[(starts > cut) & (starts <= end - margin)], later + begin)
            if len(both):
                found = both[-1]
            elif begin == cut:  # nothing before the chunk's end is common: take a longer one
                starts, counts, end, found = later + begin, later_counts, stop, cut
                break
            wide *= 2
        else:
            total += int(counts[(starts >= cut) & (starts < found)].sum())
            cut, end, starts, counts = found, stop, later + begin, later_counts
    return total + int(counts[starts >= cut].sum()), chunks


def token_counts(docs: DataFrame, path: str, chunk: int = 32768, overlap: int = 512) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and the chunks it was encoded in.

    ``path`` is a byte-level tokenizer file. Texts up to ``chunk`` characters are one chunk. A
    null or empty text has no token. Special strings in a text count as the library counts
    them by default. Nothing is shuffled; repeated rows are counted each; an empty table gives
    an empty result. Only doc_id and text are read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                rows = [spliced_count(encoder, t, chunk, overlap) if t else (0, 0) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "n_chunks"],
                )

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(count, SCHEMA)


def count_digest(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    return token_counts(docs, path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks"
    )
