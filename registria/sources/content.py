"""What a load must know of a file's bytes, its encoding and its quotes, from stretches read apart."""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .files import resolve, spread

CHUNK_BYTES, BLOCK_BYTES = 1 << 20, 64 << 20
STATES = "path string, start long, state binary, error string"
FACTS = "path string, encoding string, multiline boolean, unterminated boolean, error string"


@dataclass(frozen=True)
class Content:
    """Facts of a stretch of bytes. Those of neighbours add up to the facts of both, in any grouping.

    ``first`` holds the first three bytes. ``head`` holds the continuation bytes a stretch begins with, which
    belong to a character of the stretch before; ``inside`` says that it holds nothing else. ``tail`` holds the
    bytes of a character that goes on behind the stretch, and ``valid`` covers all between. ``odd`` is
    the parity of quotes; ``breaks`` and ``breaks_open`` say whether a line break lies within quotes if
    the stretch begins outside or inside of them.
    """

    first: bytes = b""
    head: bytes = b""
    inside: bool = True
    valid: bool = True
    tail: bytes = b""
    odd: bool = False
    breaks: bool = False
    breaks_open: bool = False

    @classmethod
    def of(cls, data: bytes) -> Content:
        lead = next((i for i, b in enumerate(data[:4]) if b & 0xC0 != 0x80), len(data[:4]))
        valid, tail = lead < 4, b""
        if valid:
            decoder = codecs.getincrementaldecoder("utf-8")("strict")
            try:
                decoder.decode(data[lead:])
                tail = decoder.getstate()[0]
            except UnicodeDecodeError:
                valid = False
        codes = np.frombuffer(data, np.uint8)
        opened = np.bitwise_xor.accumulate(codes == ord('"'))
        at_break = opened[(codes == ord("\n")) | (codes == ord("\r"))]
        return cls(
            data[:3], data[:lead], lead == len(data), valid, tail,
            bool(len(opened) and opened[-1]), bool(at_break.any()), bool((~at_break).any()),
        )

    def __add__(self, after: Content) -> Content:
        head, tail, valid = self.head, after.tail, self.valid and after.valid
        if self.inside:
            head = head + after.head
            valid = valid and len(head) <= 3
        elif self.tail or after.head:
            begun = self.tail + after.head
            decoder = codecs.getincrementaldecoder("utf-8")("strict")
            try:
                done = decoder.decode(begun)
                left = decoder.getstate()[0]
            except UnicodeDecodeError:
                done, left, valid = "", b"", False
            if after.inside:
                tail = left
            valid = valid and (after.inside or not left) and (len(done) <= 1 or not self.tail) and bool(self.tail)
        return Content(
            (self.first + after.first)[:3], head, self.inside and after.inside, valid, tail,
            self.odd ^ after.odd, self.breaks or (after.breaks_open if self.odd else after.breaks),
            self.breaks_open or (after.breaks if self.odd else after.breaks_open),
        )

    @property
    def encoding(self) -> str:
        """``utf-8-sig``, ``utf-8`` or ``latin-1``, if the stretch is a whole file."""
        if not self.valid or self.head or self.tail:
            return "latin-1"
        return "utf-8-sig" if self.first == codecs.BOM_UTF8 else "utf-8"

    @property
    def multiline(self) -> bool:
        return self.breaks

    @property
    def unterminated(self) -> bool:
        return self.odd

    def packed(self) -> bytes:
        flags = sum(f << i for i, f in enumerate((self.inside, self.valid, self.odd, self.breaks, self.breaks_open)))
        return bytes([flags, len(self.first), len(self.head), *self.first, *self.head[:4], *self.tail])

    @classmethod
    def unpacked(cls, data: bytes) -> Content:
        inside, valid, odd, breaks, breaks_open = (bool(data[0] >> i & 1) for i in range(5))
        a, b = 3 + data[1], 3 + data[1] + min(data[2], 4)
        return cls(data[3:a], data[a:b], inside, valid, data[b:], odd, breaks, breaks_open)


def content_of(chunks: Iterable[bytes]) -> Content:
    return reduce(Content.__add__, map(Content.of, chunks), Content())


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, start, size in batch[["path", "start", "size"]].itertuples(index=False):
            try:
                system, inner = resolve(path)
                with system.open_input_file(inner) as file:
                    file.seek(start)
                    chunks = (file.read(min(CHUNK_BYTES, size - at)) for at in range(0, size, CHUNK_BYTES))
                    rows.append((path, start, content_of(chunks).packed(), None))
            except (OSError, pa.ArrowException) as error:  # this file's outcome, not the others'
                rows.append((path, start, None, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(rows, columns=["path", "start", "state", "error"])


def _joined(blocks: pd.DataFrame) -> pd.DataFrame:
    path, errors = blocks["path"].iloc[0], blocks["error"].dropna()
    if len(errors):
        return pd.DataFrame([(path, None, None, None, errors.iloc[0])], columns=["path", "encoding", "multiline", "unterminated", "error"])
    whole = reduce(Content.__add__, map(Content.unpacked, blocks.sort_values("start")["state"]), Content())
    return pd.DataFrame([(path, whole.encoding, whole.multiline, whole.unterminated, None)], columns=["path", "encoding", "multiline", "unterminated", "error"])


def contents(files: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """``path, encoding, multiline, unterminated, error`` of files (``path, length``), from all their bytes.

    Tasks read blocks of ``block`` bytes, a megabyte at a time, so one large file is many tasks'
    work; what is put together per file is a few bytes a block. A file that
    cannot be read has an error and the others their facts.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)).cast("long"), F.lit(block).cast("long"))
    blocks = files.select("path", "length", F.explode(starts).alias("start"))
    blocks = blocks.select("path", "start", F.least(F.lit(block).cast("long"), F.col("length") - F.col("start")).alias("size"))
    return spread(blocks).mapInPandas(_scan, STATES).groupBy("path").applyInPandas(_joined, FACTS)
