"""Phrase collocations per language: fingerprints of all n-grams, exact counts of the frequent ones."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .common import dropped, stored
from .fingerprints import Words, batches, mixed, scan

LONGEST = 4
CHUNK = 1 << 20  # bytes whose phrases are counted together
BLANKS, ENDS = b"\t ", b".,;:!?\n\x0b\x0c\r"
END = re.compile(rb"[.,;:!?\x0A-\x0D]")
BITS_PER_ENTRY, LEAST_BITS, MOST_BITS = 16, 16, 26  # of a filter: 8 MB at most, whatever the data


@functools.lru_cache(maxsize=65536)
def _lang_print(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text cut where a piece ends; no phrase reaches over such a place."""
    at = 0
    while len(text) - at > CHUNK and (end := END.search(text, at + CHUNK)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


def _scanned(found: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Words]]:
    """Languages of some texts and the words of these, lower-cased (A-Z only)."""
    for batch in found:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
        for rows in batches(((lang, part) for lang, text in zip(langs, texts) for part in _parts(text.lower())), CHUNK):
            yield [r[0] for r in rows], scan([r[1] for r in rows], BLANKS, ENDS)


class Prints:
    """Fingerprints of language and ``n`` words from every word on, found once; as a phrase of one word has no ends, all count."""

    def __init__(self, langs: list[str], words: Words) -> None:
        own = np.array([_lang_print(x) for x in langs], np.uint64)
        self.words, self.own, self.known = words, own[words.text], {}

    def of(self, n: int) -> np.ndarray:
        if n not in self.known:
            grams = self.words.grams(n)
            self.known[n] = mixed(grams ^ self.own[: len(grams)])
        return self.known[n]


class Filter:
    """A bitmap of fingerprints: holds what was put in, and by chance some more."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, prints: np.ndarray) -> np.ndarray:
        return (self.words[(prints & self.mask) >> np.uint64(6)] >> (prints & np.uint64(63))) & np.uint64(1) == 1


def _filter(frequent: DataFrame) -> Broadcast:
    """The filter of a table of fingerprints. It is 8 MB at most; a fuller one lets more pass, which later steps count in vain."""
    rows = frequent.count()
    bits = min(max((rows * BITS_PER_ENTRY).bit_length(), LEAST_BITS), MOST_BITS)
    place = F.col("print").bitwiseAND((1 << bits) - 1)
    packed = (
        frequent.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(print & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[packed["word"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64).view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(Filter(words))


def _admitted(prints: Prints, n: int, parts: dict[int, np.ndarray]) -> np.ndarray:
    """Where a phrase of ``n`` words begins all whose ``parts`` of the filters' lengths may be frequent."""
    ok = prints.words.whole(n, prints.words.piece)
    for k, part in parts.items():
        if k <= n and len(ok):
            for i in range(n - k + 1):
                ok = ok & part[i : i + len(ok)]
    return ok


def _passed(prints: Prints, filters: dict[int, Filter]) -> dict[int, np.ndarray]:
    """For each filter's length, from which words on the phrase of that length may be frequent."""
    return {k: held.has(prints.of(k)) for k, held in filters.items()}


def _counts(texts: DataFrame, lengths: tuple[int, ...], filters: dict[int, Broadcast]) -> DataFrame:
    """(print, length, n): occurrences of the fingerprints of phrases; each task adds up its own before the shuffle."""

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: b.value for k, b in filters.items()}
        for langs, words in _scanned(found):
            here = Prints(langs, words)
            parts = _passed(here, held)
            for n in lengths:
                prints, times = np.unique(here.of(n)[_admitted(here, n, parts)], return_counts=True)
                if len(prints):
                    yield pa.record_batch([pa.array(prints.view(np.int64)), pa.array(np.full(len(prints), n, np.int32)), pa.array(times.astype(np.int64))], names=["print", "length", "n"])

    return texts.mapInArrow(count, "print long, length int, n long").groupBy("print", "length").agg(F.sum("n").alias("n"))


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that brings equal values together, where in it each of them begins)."""
    order = np.argsort(values)
    near = values[order]
    return order, np.flatnonzero(np.append(True, near[1:] != near[:-1])[: len(near)])


def _word_ids(words: Words) -> np.ndarray:
    """The same number for words of the same bytes: by fingerprint, after comparing the bytes."""
    order, first = _grouped(words.print)
    ids = np.empty(len(order), np.int64)
    ids[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    twin = order[first][ids]
    size, twin_size = words.end - words.start, (words.end - words.start)[twin]
    codes = np.frombuffer(words.data, np.uint8)
    if (same := bool((size == twin_size).all())) and len(ids):
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = bool((codes[np.repeat(words.start, size) + within] == codes[np.repeat(words.start[twin], size) + within]).all())
    if not same:
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(words.word(i), len(known)) for i in range(len(ids))], np.int64)
    return ids


def _distinct(at: np.ndarray, n: int, prints: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pointer to an occurrence, occurrences) of the phrases that begin ``at``: equal prints whose words were compared."""
    order, first = _grouped(prints[at])
    times = np.diff(np.append(first, len(order)))
    at = at[order]
    twin = np.repeat(at[first], times)
    differ = np.zeros(len(at), bool)
    for i in range(n):
        differ |= ids[at + i] != ids[twin + i]
    if not differ.any():
        return at[first], times
    rows = np.stack([ids[at + i] for i in range(n)], axis=1)  # two phrases of one fingerprint
    _, first, times = np.unique(rows, axis=0, return_index=True, return_counts=True)
    return at[first], times


class Joined:
    """The words of some texts with one blank after each, so that every phrase is a stretch of bytes."""

    def __init__(self, words: Words) -> None:
        size = words.end - words.start
        self.start = np.cumsum(size + 1) - size - 1
        self.end = self.start + size
        turns = np.zeros(len(words.data) + 1, np.int8)
        turns[words.start] += 1
        turns[words.end + 1] -= 1  # every word is followed by a byte, which becomes its blank
        self.codes = np.frombuffer(words.data, np.uint8)[np.cumsum(turns[:-1], dtype=np.int8) > 0]
        self.codes[self.end] = 32

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The ``n`` words from each of ``at`` on."""
        size = self.end[at + n - 1] - self.start[at]
        ends = np.cumsum(size)
        codes = self.codes[np.arange(int(size.sum())) + np.repeat(self.start[at] - (ends - size), size)]
        offsets = np.append(0, ends).astype(np.int64)
        whole = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
        return whole.cast(pa.binary())


def phrase_counts(docs: DataFrame, at_least: int = 30, longest: int = LONGEST) -> DataFrame:
    """(lang, length, phrase, n): exact counts of all phrases of one to ``longest`` words with ``n >= at_least``.

    A row of length 0 and phrase '' holds all word occurrences of a language. Fingerprints of
    every n-gram come from prefix polynomials in numpy, a megabyte at a time, and
    their sums, not the n-grams, are shuffled. A phrase is only as frequent as its parts: pairs are
    counted where both words are frequent, longer phrases where all pairs are, by bitmaps
    of a bounded size which let some others pass but stop no frequent one. The last pass takes the n-grams whose
    fingerprint is frequent, keeps a pointer to an occurrence, compares all others of the
    same fingerprint with it, word by word, and sends phrase and number on: counts are
    by text, so neither collisions nor the bitmaps touch them.

    Null texts are empty, null languages ``und``; other columns are not read. Rows that
    repeat count each time. An empty table gives an empty result. A task holds one piece
    of a text (up to a punctuation mark or line break), or one megabyte of several.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    filters: dict[int, Broadcast] = {}
    for lengths in ((1,), (2,), tuple(range(3, longest + 1))):
        if lengths:
            frequent = stored(_counts(texts, lengths, filters).where(F.col("n") >= at_least), "phrase-prints")
            made = {n: _filter(frequent.where(F.col("length") == n)) for n in lengths}
            filters |= made
            dropped(frequent)

    def locate(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: b.value for k, b in filters.items()}
        for langs, words in _scanned(found):
            ids = _word_ids(words)
            names, lang_of = np.unique(np.array(langs, object), return_inverse=True)
            owner = lang_of[words.text]
            here, joined = Prints(langs, words), Joined(words)
            parts, named = _passed(here, held), pa.array(names.tolist(), pa.string())
            all_words = np.bincount(owner, minlength=len(names))
            for n in range(longest + 1):
                if n:
                    first, times = _distinct(np.flatnonzero(_admitted(here, n, parts)), n, here.of(n), ids)
                    own, phrase = owner[first], joined.phrases(first, n)
                else:
                    own = np.flatnonzero(all_words)
                    times, phrase = all_words[own], pa.array([b""] * len(own), pa.binary())
                if len(own):
                    yield pa.record_batch([named.take(pa.array(own)), pa.array(np.full(len(own), n, np.int32)), phrase, pa.array(times.astype(np.int64))], names=["lang", "length", "phrase", "n"])

    located = texts.mapInArrow(locate, "lang string, length int, phrase binary, n long")
    counted = located.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n"))
    kept = counted.where((F.col("n") >= at_least) | (F.col("length") == 0))
    return kept.withColumn("phrase", F.col("phrase").cast("string"))


def collocations(docs: DataFrame, at_least: int = 30, longest: int = LONGEST, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every language.

    A phrase of 2 to ``longest`` words that occurs a >= ``at_least`` times is scored at
    every cut into a first part (l occurrences) and the rest (r) as 2,000,000 * a / (l + r),
    rounded down; its lowest cut counts, the earliest of equal ones. Phrases that lie within a longer one
    with at least 80 % of their occurrences are left out. Order: score and a descending,
    phrase ascending by bytes. Nulls, repeated rows and empty tables as in ``phrase_counts``.
    """
    counts = stored(phrase_counts(docs, at_least, longest), "phrase-counts")
    phrases = counts.where("length >= 2").select("lang", "phrase", "length", F.col("n").alias("a"))
    words = F.split("phrase", " ")

    def part(start, size):
        return F.array_join(F.slice(words, start, size), " ")

    cut = F.col("cut")
    cuts = phrases.withColumn("cut", F.explode(F.expr("sequence(1, length - 1)"))).select(
        "*", part(F.lit(1), cut).alias("left"), part(cut + 1, F.col("length") - cut).alias("right")
    )
    known = counts.where("length >= 1")
    scored = (
        cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
        .withColumn("score", F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
        .groupBy("lang", "phrase", "a", "length").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "length", "best.l", "best.r", "best.score")
    )
    inner = F.expr("flatten(transform(sequence(2, length - 1), k -> transform(sequence(1, length - k + 1), i -> array_join(slice(split(phrase, ' '), i, k), ' '))))")
    longer = (
        phrases.where("length >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    hidden = F.expr("100 * cast(longer as decimal(20,0)) >= 80 * cast(a as decimal(20,0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~hidden)
        .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .join(counts.where("length = 0").select("lang", F.col("n")), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
n as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
      from w, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k),
f as (select lang, k, phrase, count(*)::bigint as f from g group by lang, k, phrase),
c as (select lang, k, phrase, string_split(phrase, ' ') as w, f as a from f where k >= 2 and f >= 30),
cuts as (select lang, k, phrase, w, a, unnest(range(1, k)) as cut from c),
s as (select cuts.*, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f::hugeint + y.f))::bigint as score
      from cuts join f x on x.lang = cuts.lang and x.k = cut and x.phrase = array_to_string(w[1:cut], ' ')
      join f y on y.lang = cuts.lang and y.k = cuts.k - cut and y.phrase = array_to_string(w[cut + 1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_of as (select lang, a as longer, unnest(list_concat(
                 list_transform(range(1, k), lambda i: array_to_string(w[i:i + 1], ' ')),
                 case when k = 4 then [array_to_string(w[1:3], ' '), array_to_string(w[2:4], ' ')] else [] end)) as phrase
             from c where k >= 3),
hid as (select lang, phrase, max(longer) as longer from inner_of group by lang, phrase),
kept as (select b.* from b left join hid using (lang, phrase) where longer is null or 100::hugeint * longer < 80::hugeint * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
"""
