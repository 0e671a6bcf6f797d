"""Substring dedup: repeated passages confirmed by fingerprints, located by sharded automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import dropped, stored
from .fingerprints import OTHER, WORD, Words, batches, scan, segments

BLANKS = b" \t\n\x0b\x0c\r"
WINDOW, GRAM = 20, 6
# A shard's automaton holds about so many windows; a task streams about so many words past one.
WINDOWS_PER_SHARD, WORDS_PER_TASK = 40_000, 1_000_000
BLOCK = 100_000  # words of a text that may go to one shard
SALTS = 64


def _ordered(docs: DataFrame) -> DataFrame:
    """(ord, doc_id, text): ``ord`` is unique and in the order of ids, nulls last, then texts."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    again = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if again.isEmpty():
        return rows.select(F.col("doc_id").cast("long").alias("ord"), "doc_id", "text")
    placed = rows.orderBy(F.asc_nulls_last("doc_id"), "text")
    return stored(placed.select(F.monotonically_increasing_id().alias("ord"), "doc_id", "text"), "passage-texts")


def _least(prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of ``width`` neighbours from every place on, and where the first such one is."""
    value, place, reach = prints, np.arange(len(prints)), 1
    while reach < width:
        step = min(reach, width - reach)
        if len(value) <= step:
            return value[:0], place[:0]
        left = value[:-step] <= value[step:]
        value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
        reach += step
    return value, place


def _runs(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, first window, windows): stretches of windows whose least ``gram``-word fingerprint is the same one.

    The choice looks at nothing but the window's words, so equal windows have equal values.
    """
    value, place = _least(words.grams(gram), window - gram + 1)
    at = np.flatnonzero(words.whole(window)[: len(value)])
    if not len(at):
        return np.zeros(0, np.uint64), at, at
    new = np.flatnonzero(np.r_[True, (np.diff(place[at]) != 0) | (np.diff(at) != 1)])
    return value[at[new]], at[new], np.diff(np.r_[new, len(at)])


def _first_of_text(words: Words, count: int) -> np.ndarray:
    return np.searchsorted(words.text, np.arange(count))


def _find_runs(window: int, gram: int):
    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = zip(batch.column("ord").to_pylist(), batch.column("text").to_pylist())
            parts = ((o, 1 + len(t) // (BLOCK * 6), first, part) for o, t in rows for first, part in segments(t, window - 1))
            for some in batches(parts):
                words = scan([r[3] for r in some], BLANKS, b"")
                value, at, n = _runs(words, window, gram)
                own = words.text[at]
                within = at - _first_of_text(words, len(some))[own] + np.array([r[2] for r in some])[own]
                yield pa.record_batch(
                    [pa.array(value.view(np.int64)), pa.array(np.array([r[0] for r in some])[own]), pa.array(within), pa.array(n.astype(np.int32)), pa.array(np.array([r[1] for r in some])[own])],
                    names=["value", "ord", "at", "n", "blocks"],
                )

    return find


def _cut_slices(window: int):
    """Texts of the stretches of a document that go to one shard."""

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            runs = batch.column("runs")
            at, n, shard, parts = (f.to_numpy(zero_copy_only=False) for f in runs.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
            if not len(at):
                continue
            joined = (row[1:] == row[:-1]) & (shard[1:] == shard[:-1]) & (at[1:] <= at[:-1] + n[:-1])
            new = np.flatnonzero(np.r_[True, ~joined])
            last = np.r_[new[1:], len(at)] - 1
            texts, held, words, out = batch.column("text"), -1, [], []
            for r, lo, hi in zip(row[new].tolist(), at[new].tolist(), (at[last] + n[last] - 1 + window).tolist()):
                if r != held:
                    held, words = r, texts[r].as_py().split()
                out.append(b" ".join(words[lo:hi]))
            order = batch.column("ord").to_numpy()[row[new]]
            yield pa.record_batch([pa.array(c) for c in (shard[new], parts[new], order, at[new], out)], names=["shard", "parts", "ord", "at", "text"])

    return cut


SEEN = "print long, check long, shard long, ord long, at long, n long, next long, next_too long, prev long, prev_too long"


def _hash_windows(window: int):
    """Every window's fingerprints, its first place, occurrences, and the least and greatest word after and before it."""

    def hashed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            columns = [batch.column(c).to_pylist() for c in ("shard", "ord", "at", "text")]
            for some in batches(zip(*columns)):
                words = scan([r[3] for r in some], BLANKS, b"")
                at = np.flatnonzero(words.whole(window))
                if not len(at):
                    continue
                own, edged = words.text[at], np.r_[np.uint64(0), words.print, np.uint64(0)].view(np.int64)
                of = np.r_[-1, words.text, -1]
                after = np.where(of[at + window + 1] == own, edged[at + window + 1], 0)
                before = np.where(of[at] == own, edged[at], 0)
                prints, check = words.grams(window)[at], words.grams(window, OTHER)[at]
                shard, order, first = (np.array([r[i] for r in some])[own] for i in range(3))
                place = at - _first_of_text(words, len(some))[own] + first
                by = np.lexsort((place, order, check, prints))
                new = np.flatnonzero(np.r_[True, (np.diff(prints[by]) != 0) | (np.diff(check[by]) != 0)])
                top = by[new]
                ends = [f.reduceat(c[by], new) for c in (after, before) for f in (np.minimum, np.maximum)]
                arrays = [prints[top].view(np.int64), check[top].view(np.int64), shard[top], order[top], place[top], np.diff(np.r_[new, len(by)]), *ends]
                yield pa.record_batch([pa.array(c.astype(np.int64)) for c in arrays], names=SEEN.replace(" long", "").split(", "))

    return hashed


def _cut_patterns(window: int):
    """Phrases where a slice has the windows that come first: neighbours stay together if they always do.

    ``firsts`` holds a window's place times four, plus two if one word follows it at all its occurrences,
    plus one if one word goes before all of them.
    """

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out: list[tuple] = []
            for shard, parts, o, at, text, firsts in zip(*[batch.column(c).to_pylist() for c in ("shard", "parts", "ord", "at", "text", "firsts")]):
                words = text.split()
                coded = np.unique(np.array(firsts) - 4 * at)
                coded = coded[(coded >= 0) & (coded >> 2 <= len(words) - window)]
                if len(coded):
                    mine = coded >> 2
                    bound = (np.diff(mine) == 1) & (coded[:-1] & 2 == 2) & (coded[1:] & 1 == 1)
                    for stretch in np.split(mine, np.flatnonzero(~bound) + 1):
                        lo, hi = int(stretch[0]), int(stretch[-1])
                        out.append((shard, parts, o, at + lo, b" ".join(words[lo : hi + window])))
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["shard", "parts", "ord", "at", "text"])

    return cut


def _locate(slices: pd.DataFrame, patterns: pd.DataFrame) -> pd.DataFrame:
    """Streams the slices of a shard past its automaton: the stretches that occur earlier elsewhere."""
    number: dict[bytes, int] = {}
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    sizes = []
    for k, text in enumerate(patterns["text"]):
        ids = tuple([number.setdefault(w, len(number) + 1) for w in text.split()])
        machine.add_word(ids, k)
        sizes.append(len(ids))
    size, order, place = np.array(sizes), patterns["ord"].to_numpy(), patterns["at"].to_numpy()
    out = [np.zeros((0, 3), np.int64)]
    if len(machine):
        machine.make_automaton()
        for o, at, text in zip(slices["ord"], slices["at"], slices["text"]):
            if hits := list(machine.iter(tuple([number.get(w, 0) for w in text.split()]))):
                end, k = np.array(hits).T
                lo = at + end + 1 - size[k]
                hi = at + end + 1
                late = (order[k] != o) | (place[k] != lo)
                if late.any():
                    by = np.argsort(lo[late], kind="stable")
                    lo, hi = lo[late][by], np.maximum.accumulate(hi[late][by])
                    new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
                    out.append(np.stack([np.full(len(new), o), lo[new], hi[np.r_[new[1:], len(lo)] - 1]], axis=1))
    return pd.DataFrame(np.concatenate(out), columns=["ord", "lo", "hi"]).astype("int64")


def _repeats(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(ord, lo, hi): word ranges of texts that windows cover which also begin earlier."""
    runs = stored(texts.mapInArrow(_find_runs(window, gram), "value long, ord long, at long, n int, blocks long"), "passage-runs")
    again = stored(
        runs.groupBy("value").agg(F.count(F.lit(1)).alias("c"), F.min("ord").alias("home"), F.min_by("blocks", "ord").alias("blocks"), F.max("n").alias("most"))
        .where("c > 1").drop("c"),
        "passage-again",
    )
    shards = max(1, -(-(again.agg(F.sum("most")).first()[0] or 0) // WINDOWS_PER_SHARD))
    shard = F.pmod(F.xxhash64("home", F.pmod("value", "blocks")), F.lit(shards))
    placed = stored(runs.select("value", "ord", "at", "n").join(again.select("value", shard.alias("shard")), "value").drop("value"), "passage-places")
    dropped(runs)
    dropped(again)
    # a shard may hold much of all rows, so its texts meet one of several copies of its row
    parts = placed.groupBy("shard").agg(F.ceil(F.sum("n") / WORDS_PER_TASK).alias("parts")).withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("ord", "at"), F.lit(SALTS)).cast("int"))
    per_text = salted.join(parts, ["shard", "salt"]).groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("at", "n", "shard", "parts"))).alias("runs"))
    slices = texts.select("ord", "text").join(per_text, "ord").mapInArrow(_cut_slices(window), "shard long, parts long, ord long, at long, text binary")
    slices = stored(slices.withColumn("part", F.pmod(F.xxhash64("ord"), "parts")).repartition("shard", "part"), "passage-slices")
    dropped(placed)
    seen = slices.select("shard", "ord", "at", "text").mapInArrow(_hash_windows(window), SEEN)
    added = [F.sum("n").alias("n"), F.min(F.struct("ord", "at")).alias("first"), *[f(c).alias(c) for f, c in ((F.min, "next"), (F.max, "next_too"), (F.min, "prev"), (F.max, "prev_too"))]]
    coded = F.expr("first.at * 4 + if(next = next_too and next <> 0, 2, 0) + if(prev = prev_too and prev <> 0, 1, 0)")
    firsts = (
        seen.groupBy("print", "check", "shard").agg(*added).where("n > 1")
        .groupBy("shard", "first.ord").agg(F.collect_list(coded).alias("firsts"))
    )
    patterns = slices.drop("part").join(firsts, ["shard", "ord"]).mapInArrow(_cut_patterns(window), "shard long, parts long, ord long, at long, text binary")
    everywhere = patterns.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    pairs = slices.drop("parts").groupBy("shard", "part").cogroup(everywhere.groupBy("shard", "part"))
    return pairs.applyInPandas(_locate, "ord long, lo long, hi long")


def _cut_texts(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.split()
            keep = np.ones(len(words), bool)
            for span in spans or ():
                keep[span["lo"] : span["hi"]] = False
            gone = int(len(words) - keep.sum())
            kept = b" ".join([w for w, k in zip(words, keep) if k] if gone else words)
            out.append((len(words), gone, kept, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        yield pa.record_batch([batch.column("doc_id"), *arrays], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text), kept_sha256: documents less their repeated passages.

    Words are runs of bytes other than ASCII white space. A word goes if a window of ``window`` words
    covers it whose sequence also starts earlier: in a document of smaller id, or before in the same one.

    1. Confirm. Each window is known by the least of its ``gram``-word fingerprints, which few
       neighbours share, so one row stands for some eight windows. Values seen once are done with. The
       stretches of the others are cut out, their windows are hashed to 128 bits and added up; those seen
       again are repeated, and their first place is known.
    2. Compile. Windows that always follow each other are one phrase; the phrases become automata over
       word numbers, some 40,000 windows in each. Values that come first in the same document go to the same shard, so a text is
       streamed past few automata, however many there are.
    3. Stream. All stretches of a shard pass its automaton, which compares words and finds
       every occurrence; all but the first are removed. Shards with many occurrences are several tasks.

    Null texts count as empty: no words, nothing removed. Null ids come last. Documents that share an
    id, or have none, are ordered by text; of rows that repeat entirely one counts as the earlier.
    An empty table gives an empty result. Other columns are not read. Very long texts are hashed in parts.
    """
    texts = _ordered(docs)
    spans = stored(_repeats(texts, window, gram).groupBy("ord").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "passage-spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = texts.join(spans, "ord", "left").select("doc_id", "text", "spans").mapInArrow(_cut_texts, f"doc_id {kind}, n_words long, n_removed long, kept binary, kept_sha256 string")
    return cut.withColumn("kept", F.col("kept").cast("string"))


def repeat_digest(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``without_repeats`` without the texts: doc_id, n_words, n_removed, kept_sha256; awkward rows as there."""
    return without_repeats(docs, window, gram).drop("kept")


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, unnest(range(1, len(w) - 18)) as s, w from d where len(w) >= 20),
h as (select doc_id, s, array_to_string(w[s:s + 19], ' ') as t from g),
r as (select doc_id, s from h qualify row_number() over (partition by t order by doc_id, s) > 1),
gone as (select distinct doc_id, s + i as p from r, (select unnest(range(0, 20)) as i)),
e as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
k as (select e.doc_id, count(*) filter (where gone.p is not null) as n_removed,
             string_agg(word, ' ' order by e.p) filter (where gone.p is null) as kept
      from e left join gone on gone.doc_id = e.doc_id and gone.p = e.p group by e.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id)
"""
