"""Rabin-Karp fingerprints: prefix polynomials over the bytes of words and over the words of texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

# Odd numbers, so that they have an inverse modulo 2**64; drawn once at random.
BYTE, WORD, OTHER = 0x9D7C3F1B5A2E8461, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
SEGMENT = 1 << 18  # bytes that are hashed at once: their arrays stay in the processor's cache
GAP = re.compile(rb"[\x20\x09-\x0D]")
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``base`` and of its inverse, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        known = _POWERS[base] = (made[0], made[1])
    return known[0][:n], known[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits, so that polynomials of polynomials do not line up."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values))[0], out=out[1:])
    return out


class Words(NamedTuple):
    """The words of some texts: bounds in ``data``, number of the text and of the piece, fingerprint."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    piece: np.ndarray
    print: np.ndarray

    def grams(self, n: int, base: int = WORD) -> np.ndarray:
        """The fingerprint of the ``n`` words from every word on, whatever text they lie in."""
        count = len(self.print)
        if count < n:
            return np.zeros(0, np.uint64)
        prefix = _prefix(mixed(self.print + np.uint64(base)), base)
        return mixed((prefix[n:] - prefix[:-n]) * _powers(base, count - n + 1)[1] + np.uint64(n))

    def whole(self, n: int, by: np.ndarray | None = None) -> np.ndarray:
        """Whether the ``n`` words from every word on lie in one text (or one piece, given ``piece``)."""
        group = self.text if by is None else by
        return group[: len(group) - n + 1] == group[n - 1 :] if len(group) >= n else np.zeros(0, bool)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def scan(texts: list[bytes], blanks: bytes, ends: bytes) -> Words:
    """Words of ``texts``: maximal runs of bytes that are neither ``blanks`` nor ``ends``; the latter end a piece."""
    mark = ends[:1] or blanks[:1]
    data = mark.join(texts) + mark
    kinds = np.zeros(256, np.int8)
    kinds[list(blanks)], kinds[list(ends)] = 1, 2
    codes = np.frombuffer(data, np.uint8)
    kind = kinds[codes]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = kind == 0
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[0::2], edges[1::2]
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    prefix = _prefix(codes.astype(np.uint64) + np.uint64(1), BYTE)
    hashes = (prefix[end] - prefix[start]) * _powers(BYTE, len(data))[1][start] if len(start) else np.zeros(0, np.uint64)
    text = np.searchsorted(first, start, side="right") - 1
    piece = np.cumsum(kind == 2)[start] if ends else text
    return Words(data, start, end, text, piece, mixed(hashes))


def segments(text: bytes, overlap: int, limit: int = SEGMENT) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, bytes): a long text in parts that share ``overlap`` words, cut at blanks."""
    at, first, size = 0, 0, limit
    while len(text) - at > size and (gap := GAP.search(text, at + size)):
        spans = [m.start() for m in WORDS.finditer(text, at, gap.start())]
        if len(spans) <= overlap:  # very long words: look further
            size *= 2
            continue
        yield first, text[at : gap.start()]
        first, at, size = first + len(spans) - overlap, spans[-overlap] if overlap else gap.end(), limit
    yield first, text[at:]


def batches(rows: Iterable[tuple], limit: int = SEGMENT) -> Iterator[list[tuple]]:
    """Rows, whose last field holds bytes, in lists of about ``limit`` bytes."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[-1]) > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[-1])
    if held:
        yield held
