"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tokens import slices

ORDERS = (3, 4, 5)
BITS = 18  # n-grams are hashed to 2**18 features
BLOCK = 4096
SLICE_CHARS = 1 << 20
HELD_BYTES = 1 << 18  # of texts that a task takes apart at once; their n-grams take many times that


def held_out(doc_id: Column) -> Column:
    """True for the rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sliced(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` characters; a longer text has a range of its own."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, feature) of every n-gram of lower-cased texts, one order at a time."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.array([len(t) for t in low], dtype=np.int64)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the text's end
    hashed = np.zeros(len(codes), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        if order > len(codes):
            break
        hashed = hashed[:len(codes) - order + 1] * np.uint32(0x01000193) + codes[order - 1:] * np.uint32(0x9E3779B1)
        if order in ORDERS:
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * order)
            inside = left[:len(mixed)] >= order
            yield owner[:len(mixed)][inside], (mixed >> np.uint32(32 - BITS))[inside]


def present(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the features present in each text, of the ``wanted`` ones if given."""
    kind = np.uint32 if len(texts) <= 1 << (32 - BITS) else np.int64  # short keys are sorted faster
    keys = [np.zeros(0, dtype=kind)]
    for owner, feature in ngrams(texts):
        if wanted is not None:
            hit = wanted[feature]
            owner, feature = owner[hit], feature[hit]
        keys.append((owner.astype(kind) << kind(BITS)) | feature.astype(kind))
    both = np.concatenate(keys)
    both.sort()
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return both >> kind(BITS), both & kind((1 << BITS) - 1)


def _read(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a column, a slice at a time; null texts are empty."""
    for first, texts in slices(column, HELD_BYTES):
        yield first, ["" if t is None else t for t in texts]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each label: texts that hold a feature, in blocks of features."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy()
        for first, texts in _read(batch.column(1)):
            owner, feature = present(texts)
            toxic = labels[first:first + len(texts)][owner] == 1
            counts[1] += np.bincount(feature[toxic], minlength=1 << BITS)
            counts[0] += np.bincount(feature[~toxic], minlength=1 << BITS)
    if counts.any():
        blocks = range(0, 1 << BITS, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), *(pa.array([c[i:i + BLOCK].tobytes() for i in blocks], pa.binary()) for c in counts)],
            ["block", "clean", "toxic"],
        )


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = [sum(np.frombuffer(x, dtype=np.int64) for x in frame[c]).tobytes() for c in ("clean", "toxic")]
    return pd.DataFrame({"block": [frame["block"].iloc[0]], "clean": [total[0]], "toxic": [total[1]]})


def fit_linear(starts: np.ndarray, features: np.ndarray, scaled: np.ndarray, labels: np.ndarray,
               penalty: float = 1e-3, rounds: int = 250) -> tuple[np.ndarray, float]:
    """Logistic regression on rows of present features with ``scaled`` values, by full-batch Adam."""
    rows, size = len(labels), len(scaled)
    owner = np.repeat(np.arange(rows), np.diff(np.append(starts, len(features))))
    values = scaled[features]
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weights, bias = np.full(size, 0.1), float(np.log(rate / (1 - rate)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        margin = bias + np.bincount(owner, values * weights[features], minlength=rows)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / rows
        grad = np.append(np.bincount(features, values * error[owner], minlength=size) + penalty * weights, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, bias


@dataclass
class Model:
    """What a feature adds to the margin (its weight times its log-count ratio), and the bias."""

    margin: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        owner, feature = present(texts, self.margin != 0)
        total = self.bias + np.bincount(owner, self.margin[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20000, least_count: int = 3,
        least_ratio: float = 1.0, least_z: float = 2.5) -> Model:
    """Learns from at most ``max_rows`` labelled documents, drawn by a hash of their ids.

    The sampled ids are few by construction, so they travel to the documents, and only the
    sampled texts reach Python. A feature's log-count ratio is the logarithm of its smoothed share among
    toxic documents over that among clean ones; features seen in fewer than ``least_count`` texts or with
    a ratio nearer to 0 than ``least_ratio``, or than ``least_z`` of its standard errors, are left out. Labels that are null or contradict each other are not used.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .where("toxic = _most").drop("_most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    sample = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).select(F.col("toxic").cast("int").alias("toxic"), "text")
    )
    blocks = (
        sample.mapInArrow(_count, "block int, clean binary, toxic binary")
        .groupBy("block").applyInPandas(_add, "block int, clean binary, toxic binary").collect()  # 64 rows
    )
    counts = np.zeros((2, 1 << BITS))
    for row in blocks:
        for label, name in enumerate(("clean", "toxic")):
            counts[label, row["block"]:row["block"] + BLOCK] = np.frombuffer(row[name], dtype=np.int64)
    shares = [(c + 1) / (c.sum() + len(c)) for c in counts]
    ratio = np.log(shares[1] / shares[0])
    surprise = np.abs(ratio) / np.sqrt((1 / (counts + 1)).sum(axis=0))
    chosen = np.flatnonzero((counts.sum(axis=0) >= least_count) & (np.abs(ratio) >= least_ratio) & (surprise >= least_z))
    if not len(chosen):
        return Model(np.zeros(1 << BITS), float(np.log(1e-3 / (1 - 1e-3))))
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[chosen] = True
    place = np.zeros(1 << BITS, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    scaled = ratio[chosen]

    def chosen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _read(batch.column(1)):
                owner, feature = present(texts, wanted)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                found = pa.array([place[feature[x:y]].tobytes() for x, y in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), found], ["toxic", "features"])

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(y, np.frombuffer(f, dtype=np.int32)) for frame in frames for y, f in zip(frame["toxic"], frame["features"])]
        if rows:
            rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))  # whatever order the tasks came in
            sizes = np.array([len(f) for _, f in rows])
            weights, bias = fit_linear(
                np.cumsum(sizes) - sizes, np.concatenate([f for _, f in rows]), scaled, np.array([float(y) for y, _ in rows])
            )
            yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    learned = (
        sample.mapInArrow(chosen_features, "toxic int, features binary").coalesce(1)
        .mapInPandas(learn, "weights binary, bias double").collect()
    )
    margin = np.zeros(1 << BITS)
    margin[chosen] = np.frombuffer(learned[0]["weights"]) * scaled
    return Model(margin, learned[0]["bias"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` (0 to 1): the probability of label 1. Null texts score as empty ones."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _read(batch.column(1)):
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(model.scores(texts), pa.float64())], ["doc_id", "score"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(score, "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 20000) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns as they are."""
    model, at = fit(docs, labels, max_rows), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _read(batch.column(at)):
                yield batch.slice(first, len(texts)).filter(pa.array(model.scores(texts) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def toxicity_digest(docs: DataFrame, labels: DataFrame, max_rows: int = 20000) -> DataFrame:
    """Every document's score: doc_id, held_out, score, predicted.

    Fitted as ``fit`` says; without usable labels every document gets the same low score. Nothing is
    shuffled to score, repeated rows are scored each, and an empty table gives an empty
    result. Only doc_id and text of the documents, and doc_id and toxic of the labels, are read.
    """
    return scored(docs, fit(docs, labels, max_rows)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
