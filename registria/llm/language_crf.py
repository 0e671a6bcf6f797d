"""Language identification: a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored
from .tokens import slices
from .toxicity import held_out, sliced

BITS = 16
SEGMENT = 32  # words that the recursions take in step for all segments at once
WINDOW, WINDOWS = 24, 6  # words of a training window, windows of a document


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not len(_LETTER):
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


_LETTER: list[np.ndarray] = []


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.uint32(len(parts) * 0x9E3779B1 & 0xFFFFFFFF)
    for p in parts:
        h = (h ^ p) * np.uint32(0x01000193)
        h = h ^ (h >> np.uint32(13))
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


@dataclass
class Words:
    """Words of texts: which text each is of, its letters, and the features of every letter."""

    text: np.ndarray
    length: np.ndarray
    first: np.ndarray
    grams: np.ndarray  # letters x features: bigram, trigram, 4-gram ending at the letter, suffixes at word ends
    lexicon: np.ndarray  # words: the whole word

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """The sum of its features' weights for every word: words x languages."""
        if not len(self.first):
            return np.zeros((0, weights.shape[1]), dtype=weights.dtype)
        per_letter = weights[self.grams[:, 0]]
        for j in range(1, self.grams.shape[1]):
            per_letter = per_letter + weights[self.grams[:, j]]
        return np.add.reduceat(per_letter, self.first, axis=0) / self.length[:, None] ** 0.5 + weights[self.lexicon]


def words_of(texts: list[str]) -> Words:
    """Words are runs of letters, lower-cased. Affixes are n-grams that touch the word's edges."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) + 1 for t in low])
    letter = letters()[codes]
    edge = np.where(letter, codes, np.uint32(32))
    is_first = letter & ~np.concatenate([[False], letter[:-1]])
    at = np.flatnonzero(letter)
    first = np.searchsorted(at, np.flatnonzero(is_first))
    padded = np.concatenate([np.full(3, 32, dtype=np.uint32), edge, [np.uint32(32)]])
    c0, c1, c2, c3, after = padded[at + 3], padded[at + 2], padded[at + 1], padded[at], padded[at + 4]
    c2 = np.where(c1 == 32, np.uint32(32), c2)  # nothing from before the word
    c3 = np.where(c2 == 32, np.uint32(32), c3)
    suffix = np.where(after == 32, np.uint32(1), np.uint32(0))
    grams = np.stack([_hash(c1, c0), _hash(c2, c1, c0), _hash(c2, c1, c0, suffix), _hash(c3, c2, c1, c0, suffix)], axis=1)
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    mixed = (c0 + place.astype(np.uint32) * np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA6B)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
    whole = np.add.reduceat(mixed, first, dtype=np.uint32) if len(first) else np.zeros(0, dtype=np.uint32)
    owner = np.searchsorted(ends, at[first], side="right") if len(first) else np.zeros(0, dtype=np.int64)
    return Words(owner, length, first, grams, _hash(whole, whole >> np.uint32(16)))


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def forward_backward(emissions: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward vectors of every word of chains laid end to end, and the scores' exponentials.

    ``counts``: words of each chain (none is 0); ``moves``: exponentials of the transition weights. A chain is
    cut into segments; what a segment does to a vector is a small matrix, so segment borders
    are found first and then all segments run at once.
    """
    size = emissions.shape[1]
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-12
    parts = -(-counts // SEGMENT)
    chain = np.repeat(np.arange(len(counts)), parts)
    order = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(counts) - counts, parts) + order * SEGMENT
    inside = np.minimum(SEGMENT, counts[chain] - order * SEGMENT)
    steps = begin[:, None] + np.arange(SEGMENT)
    real = np.arange(SEGMENT) < inside[:, None]
    es = np.ones((len(chain), SEGMENT, size))
    es[real] = e[steps[real]]
    heads = order == 0
    enter, leave = np.full((len(chain), size), 1 / size), np.full((len(chain), size), 1 / size)
    many = np.flatnonzero(parts[chain] > 1)
    if len(many):
        through = np.broadcast_to(np.eye(size), (len(many), size, size)).copy()
        for t in range(SEGMENT):
            moved = np.where(heads[many][:, None, None], through, through @ moves) if t == 0 else through @ moves
            moved = moved * es[many, t][:, None, :]
            moved = moved / moved.sum(axis=(1, 2), keepdims=True)
            through = np.where(real[many, t][:, None, None], moved, through)
        matrix = np.zeros(len(chain), dtype=np.int64)
        matrix[many] = np.arange(len(many))
        last = int(parts.max())
        starts = np.cumsum(parts) - parts
        for k in range(1, last):
            here = starts[parts > k] + k
            enter[here] = _scaled(np.einsum("si,sij->sj", enter[here - 1], through[matrix[here - 1]]))
        for k in range(last - 2, -1, -1):
            here = starts[parts > k + 1] + k
            leave[here] = _scaled(np.einsum("sij,sj->si", through[matrix[here + 1]], leave[here + 1]))
    alpha, beta = np.empty_like(es), np.empty_like(es)
    a, b = enter, leave
    for t in range(SEGMENT):
        moved = np.where(heads[:, None], a, a @ moves) if t == 0 else a @ moves
        a = np.where(real[:, t][:, None], _scaled(moved * es[:, t]), a)
        alpha[:, t] = a
    for t in range(SEGMENT - 1, -1, -1):
        beta[:, t] = b
        b = np.where(real[:, t][:, None], _scaled((es[:, t] * b) @ moves.T), b)
    return alpha[real], beta[real], e


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    moves: np.ndarray  # transition weights, from and to

    def marginals(self, words: Words, counts: np.ndarray) -> np.ndarray:
        """The probability of every language at every word."""
        alpha, beta, _ = forward_backward(words.emissions(self.weights), np.exp(self.moves), counts)
        return _scaled(alpha * beta)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language with most letters, by the words' marginals, and its share; ``und`` without letters."""
        words = words_of(texts)
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        if not len(words.text) or not self.languages:
            return names, score
        has, counts = np.unique(words.text, return_counts=True)
        share = self.marginals(words, counts) * words.length[:, None]
        sums = np.add.reduceat(share, np.cumsum(counts) - counts, axis=0)
        best = sums.argmax(axis=1)
        score[has] = np.clip(sums.max(axis=1) / sums.sum(axis=1), 0, 1)
        for i, j in zip(has, best):
            names[i] = self.languages[j]
        return names, score


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stretches of words spread over every sampled text."""
    for frame in frames:
        out = []
        for lang, text in zip(frame["lang"], frame["text"]):
            words = text.split() if isinstance(text, str) else []
            spots = np.unique(np.linspace(0, max(0, len(words) - WINDOW), WINDOWS).astype(int))
            out += [(lang, " ".join(words[s:s + WINDOW])) for s in spots if words]
        yield pd.DataFrame(out, columns=["lang", "window"])


def train(windows: list[tuple[str, str]], epochs: int = 4, batch: int = 256, rate: float = 0.3, seed: int = 7) -> Model:
    """Learns weights and transitions by stochastic gradient (Adagrad) on the conditional likelihood.

    Windows of different documents are strung together, one to three in a chain, so that texts that
    switch language are seen and the cost of a switch is learned.
    """
    languages = sorted({lang for lang, _ in windows})
    code, draw = {lang: i for i, lang in enumerate(languages)}, np.random.default_rng(seed)
    size = len(languages)
    weights, moves = np.zeros((1 << BITS, size)), np.zeros((size, size))
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for begin in range(0, len(order), batch):
            chosen = [windows[i] for i in order[begin:begin + batch]]
            words = words_of([w for _, w in chosen])
            if not len(words.text):
                continue
            truth = np.array([code[lang] for lang, _ in chosen])[words.text]
            cut = np.cumsum(draw.integers(1, 4, len(chosen)))
            chain = np.searchsorted(cut, words.text, side="right")
            counts = np.unique(chain, return_counts=True)[1]
            alpha, beta, e = forward_backward(words.emissions(weights), np.exp(moves), counts)
            error = _scaled(alpha * beta)
            error[np.arange(len(truth)), truth] -= 1
            error /= len(counts)
            inner = np.ones(len(truth), dtype=bool)
            inner[np.cumsum(counts) - counts] = False
            now = np.flatnonzero(inner)
            pairs = alpha[now - 1][:, :, None] * np.exp(moves)[None] * (e[now] * beta[now])[:, None, :]
            grad_m = (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            np.subtract.at(grad_m, (truth[now - 1], truth[now]), 1)
            grad_m /= len(counts)
            per_letter = np.repeat(error / words.length[:, None] ** 0.5, words.length, axis=0)
            for j in range(size):
                grad = np.bincount(words.lexicon, error[:, j], minlength=1 << BITS)
                for g in range(words.grams.shape[1]):
                    grad += np.bincount(words.grams[:, g], per_letter[:, j], minlength=1 << BITS)
                seen_w[:, j] += grad ** 2
                weights[:, j] -= rate * grad / np.sqrt(seen_w[:, j])
            seen_m += grad_m ** 2
            moves -= 0.1 * rate * grad_m / np.sqrt(seen_m)
    return Model(languages, weights, moves)


def fit(docs: DataFrame, per_language: int = 1000) -> Model:
    """Learns from at most ``per_language`` documents of each language, drawn by a hash of their ids.

    Only those documents' windows (six of 24 words, spread over the text) reach the one task that trains.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = stored(
        known.select("doc_id", "lang").distinct().withColumn("_r", rank).where(F.col("_r") <= per_language).drop("_r"), "lang-sample"
    )
    sample = known.select("doc_id", "lang", "text").join(picked, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.max("text").alias("text"))

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = sorted({(lang, w) for frame in frames for lang, w in zip(frame["lang"], frame["window"])})
        if windows:
            model = train(windows)
            yield pd.DataFrame({"languages": [model.languages], "weights": [model.weights.astype("<f4").tobytes()],
                                "moves": [model.moves.tobytes()]})

    rows = (
        sample.select("lang", "text").mapInPandas(_windows, "lang string, window string").coalesce(1)
        .mapInPandas(learn, "languages array<string>, weights binary, moves binary").collect()
    )
    if not rows:
        return Model([], np.zeros((1 << BITS, 0), dtype="<f4"), np.zeros((0, 0)))
    size = len(rows[0]["languages"])
    return Model(list(rows[0]["languages"]), np.frombuffer(rows[0]["weights"], dtype="<f4").reshape(-1, size),
                 np.frombuffer(rows[0]["moves"]).reshape(size, size))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for whole texts."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                filled = ["" if t is None else t for t in texts]
                found = [model.predict(filled[a:b]) for a, b in sliced(filled)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array([n for names, _ in found for n in names], pa.string()),
                     pa.array(np.concatenate([s for _, s in found]), pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_digest(docs: DataFrame, per_language: int = 1000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if no language was
    learned. Repeated rows are predicted each; an empty table gives an empty result. Only doc_id, text and lang are read.
    """
    return predicted(docs, fit(docs, per_language)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
