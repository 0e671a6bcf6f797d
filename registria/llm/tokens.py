"""Token ids and counts of long texts from a tokenizer file, by units that never interact."""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Python's \s holds all Unicode white space (and four control characters more).
RAGGED = re.compile(r" \s|\s ")
GAP = re.compile(r"(?<=\S) (?=\S)")
# The same for Arrow, whose \s is ASCII only.
WHITE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
RAGGED_ARROW = f" [{WHITE}]|[{WHITE}] "
EDGED_ARROW = rf"\A[{WHITE}]|[{WHITE}]\z|\A\z"
JOINED_UNITS = 1 << 16
MEMO_ENTRIES = 300_000
MEMO_CHARS = 48
SLICE_BYTES = 4 << 20


@functools.lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def units(text: str) -> list[str]:
    """``text`` cut at its single spaces; every unit but the first has lost the space before it.

    A byte-level pre-tokenizer scans from left to right and only looks ahead. At one space
    between two characters that are not white space no pattern can reach over from the left
    (words hold no white space), so a new piece begins there whatever came before: the units
    are encoded apart with the same ids. A text whose spaces touch other white space is cut
    only where the rule holds.
    """
    return GAP.split(text) if RAGGED.search(text) else text.split(" ")


def unit_lists(texts: pa.Array) -> pa.Array:
    """``units`` of every text of a column without nulls, as lists."""
    ragged = pc.match_substring_regex(texts, RAGGED_ARROW).to_numpy(zero_copy_only=False)
    if not ragged.any():
        return pc.split_pattern(texts, " ")
    odd = pa.array([units(t) for t in texts.filter(pa.array(ragged)).to_pylist()], pa.list_(pa.string()))
    return merged(pc.split_pattern(texts.filter(pa.array(~ragged)), " "), odd, ragged)


def merged(plain: pa.Array, other: pa.Array, is_other: np.ndarray) -> pa.Array:
    """Values of both in the order that ``is_other`` has them."""
    order = np.argsort(np.argsort(is_other, kind="stable"))
    return pa.concat_arrays([plain, other]).take(pa.array(order))


def binaries(bounds: np.ndarray, data: pa.Buffer) -> pa.Array:
    """``data`` cut at ``bounds`` as a binary column."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), data])


# The pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def ranked(path: str) -> tiktoken.Encoding | None:
    """The same vocabulary for the faster merging by ranks, or None unless that gives the same ids.

    Merging the pair whose result has the smallest id is the same as taking merges in the
    order of the file if ids follow that order; nothing else may touch the text.
    """
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    model, before = stated["model"], stated["pre_tokenizer"] or {}
    vocabulary = model.get("vocab") or {}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges") or []]
    merged = [vocabulary.get("".join(p), -1) for p in pairs]
    plain = (
        model.get("type") == "BPE" and not stated["normalizer"] and before.get("type") == "ByteLevel"
        and before.get("use_regex") and not before.get("add_prefix_space") and not stated["post_processor"]
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and all(a < b for a, b in zip(merged, merged[1:]))
    )
    if not plain:
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    as_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in stated["added_tokens"]}
    ranks = {bytes(as_byte[c] for c in word): i for word, i in vocabulary.items() if word not in added}
    if len(ranks) != len(merged) + 256 or max(ranks[bytes([b])] for b in range(256)) > min(merged):
        return None
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> np.ndarray:
    """Length in bytes of every token of ``ranked``, by id."""
    encoding = ranked(path)
    sizes = np.zeros(encoding.n_vocab, dtype=np.int64)
    for token in encoding.token_byte_values():
        sizes[encoding.encode_single_token(token)] = len(token)
    return sizes


class Encoder:
    """Ids of units by the tokenizer; what was encoded is remembered, up to a fixed number of units."""

    def __init__(self, path: str, width: str = "<u2"):
        self.tokenizer = load(path)
        self.ranked = ranked(path)
        self.token_bytes = token_bytes(path) if self.ranked else None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width, self.code = width, "H" if width == "<u2" else "I"
        self.memo: dict[str, bytes] = {}

    def pieces(self, text: str, leading: bool = False) -> list[bytes]:
        """Packed ids of every unit. ``leading``: the text begins with a unit's own space."""
        words = units(text)
        first = [] if leading else [self._encode([words[0]])[0]]
        rest = words[1:] if not leading else words
        try:
            return first + list(map(self.memo.__getitem__, rest))
        except KeyError:
            pass
        missing = list({w for w in rest if w not in self.memo})
        if len(self.memo) + len(missing) > MEMO_ENTRIES:
            self.memo.clear()
            missing = list(set(rest))
        got = dict(zip(missing, self._encode([" " + w for w in missing])))
        self.memo.update((w, ids) for w, ids in got.items() if len(w) <= MEMO_CHARS)
        return first + [got.get(w) or self.memo[w] for w in rest]

    def packed(self, texts: pa.Array, end: bytes) -> pa.Array:
        """Packed ids of every text (null: none) of a column, and ``end``, as a binary column.

        Each distinct unit of the column is encoded once, and Arrow puts the texts together.
        """
        lists = unit_lists(texts.cast(pa.string()).fill_null(""))
        words, counts = lists.flatten(), pc.list_value_length(lists).to_numpy()
        begins, rows = np.cumsum(counts) - counts, np.arange(len(lists))
        spaced = np.ones(len(words), dtype=bool)
        spaced[begins] = False
        rest = words.filter(pa.array(spaced)).dictionary_encode()
        known = self._encode_spaced(rest.dictionary)
        first = pa.array(self._encode(words.take(pa.array(begins)).to_pylist()), pa.binary())
        pieces = pa.concat_arrays([known, first, pa.array([end], pa.binary())])
        begins = begins + rows  # with an end after every text
        ends = begins + counts
        index, inner = np.empty(len(words) + len(rows), dtype=np.int64), np.ones(len(words) + len(rows), dtype=bool)
        inner[begins] = inner[ends] = False
        index[begins], index[ends], index[inner] = len(known) + rows, len(pieces) - 1, rest.indices.to_numpy()
        flat = pieces.take(pa.array(index))
        stops = np.cumsum(pc.binary_length(flat).to_numpy(), dtype=np.int64)
        return binaries(np.append(0, stops[ends]), flat.buffers()[2])

    def _encode_spaced(self, words: pa.Array) -> pa.Array:
        """Packed ids of units that have lost the space before them.

        Units that neither begin nor end with white space do not interact when joined by their
        spaces: many are encoded in one call, and the lengths of the tokens tell them apart.
        """
        found = [pa.array([], pa.binary())]
        for begin in range(0, len(words), JOINED_UNITS):
            bare = words.slice(begin, JOINED_UNITS)
            texts = pc.binary_join_element_wise("", bare, " ")
            if self.ranked is None:
                found.append(pa.array(self._encode(texts.to_pylist()), pa.binary()))
                continue
            alone = pc.match_substring_regex(bare, EDGED_ARROW)
            for added in self.added:
                alone = pc.or_(alone, pc.match_substring(texts, added))
            alone = alone.to_numpy(zero_copy_only=False)
            joined = texts.filter(pa.array(~alone))
            whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), "")[0].as_py()
            ids = np.array(self.ranked.encode_ordinary(whole), dtype=self.width)
            ends = np.cumsum(pc.binary_length(joined).to_numpy(), dtype=np.int64)
            stops = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
            plain = binaries(np.append(0, stops) * ids.itemsize, pa.py_buffer(ids))
            other = pa.array(self._encode(texts.filter(pa.array(alone)).to_pylist()), pa.binary())
            found.append(merged(plain, other, alone) if len(other) else plain)
        return pa.concat_arrays(found)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype=self.width).tobytes() for e in done]
        out = []
        for text in texts:
            if any(a in text for a in self.added):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            else:
                ids = self.ranked.encode_ordinary(text)
            out.append(struct.pack(f"<{len(ids)}{self.code}", *ids))
        return out

    def inside(self, unit: str) -> tuple[list[int], list[int]]:
        """Starts of the pre-tokens inside a unit and the number of ids of each."""
        done = self.tokenizer.encode(unit, add_special_tokens=False)
        starts, counts, last = [], [], object()
        for word, (begin, _) in zip(done.word_ids, done.offsets):
            if word != last:
                starts.append(begin)
                counts.append(0)
                last = word
            counts[-1] += 1
        return starts, counts


def stretches(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of a string column, a few MB at a time."""
    rows, begin, size = len(column), 0, 0
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for i in range(rows):
        if i > begin and size + lengths[i] > most:
            yield begin, column.slice(begin, i - begin)
            begin, size = i, 0
        size += lengths[i]
    if begin < rows:
        yield begin, column.slice(begin)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, values) of a string column, a few MB at a time."""
    for first, rows in stretches(column, most):
        yield first, rows.to_pylist()
