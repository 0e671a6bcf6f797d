"""Counts and packing against the tokenizer library on whole texts."""

import random
import zlib
from collections import Counter, defaultdict
from unittest import mock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st

from registria.llm import packing, token_counts, tokens

from .fixtures import no_docs, odd_docs, odd_rows, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text) -> list[int]:
    return tokens.load(PATH).encode(text or "", add_special_tokens=False).ids


PARTS = ["a", "the", "don't", " ", "  ", "\n", "\t", "\x1f", "\x85", " ", "é", "漢字", "🙂", "12", "...", "<|endoftext|>", "<|endof", "'s", "supercalifragilistic", " x"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join))
def test_units_never_interact(text):
    got = np.frombuffer(b"".join(tokens.Encoder(PATH).pieces(text)), dtype="<u2").tolist()
    assert got == ids_of(text)


TEXTS = st.none() | st.lists(st.sampled_from([*PARTS, " ", " ", " the", " "]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8), st.integers(1, 9), st.booleans())
def test_columns_are_packed_as_texts(texts, joined, by_ranks):
    encoder = tokens.Encoder(PATH)
    encoder.ranked = encoder.ranked if by_ranks else None
    with mock.patch.object(tokens, "JOINED_UNITS", joined):
        got = encoder.packed(pa.array(["cut off", *texts], pa.string()).slice(1), b"\1\0").to_pylist()
    assert [np.frombuffer(g, dtype="<u2").tolist() for g in got] == [[*ids_of(t), 1] for t in texts]


def test_rare_words_cost_no_call_each():
    """A text of words that are not met again took a call of the library, and its Python, for each."""
    encoder, calls = tokens.Encoder(PATH), []
    encode = encoder.ranked.encode_ordinary
    encoder.ranked = mock.Mock(encode_ordinary=lambda text: calls.append(text) or encode(text))
    texts = [" ".join(f"w{i}q{k}" for k in range(300)) for i in range(20)]
    got = encoder.packed(pa.array(texts), b"\1\0").to_pylist()
    assert [np.frombuffer(g, dtype="<u2").tolist() for g in got] == [[*ids_of(t), 1] for t in texts]
    assert len(calls) <= len(texts) + 1


def test_white_space_is_the_same_for_arrow():
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    want = [tokens.RAGGED.search(f"a {c}b") is not None for c in signs]
    assert pc.match_substring_regex(pa.array([f"a {c}b" for c in signs]), tokens.RAGGED_ARROW).to_pylist() == want
    assert pc.match_substring_regex(pa.array([f"{c}b" for c in signs]), tokens.EDGED_ARROW).to_pylist() == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=120).map("".join), st.integers(20, 90), st.integers(1, 30))
def test_spliced_count(text, chunk, overlap):
    assert token_counts.spliced_count(tokens.Encoder(PATH), text, chunk, min(overlap, chunk))[0] == len(ids_of(text))


@pytest.mark.parametrize("text", ["x" * 5000, "ab1 " * 3000, " " * 3000, "漢字" * 2000, "a\n\n" * 1500, "<|endoftext|>" * 300])
def test_spliced_count_widens(text):
    assert token_counts.spliced_count(tokens.Encoder(PATH), text, 1000, 10)[0] == len(ids_of(text))


def test_count_digest(spark):
    got = Counter(tuple(r.values())[:4] for r in rows_of(token_counts.count_digest(odd_docs(spark), PATH)))
    want = Counter((r[0], len((r[1] or "").encode()), n := len(ids_of(r[1])), n > 1024) for r in odd_rows())
    assert got == want
    assert token_counts.count_digest(no_docs(spark), PATH).count() == 0


def packed(spark, docs, texts: dict, **more):
    rows = rows_of(packing.pack(docs, PATH, length=256, window=1024, **more))
    whole = {d: [*ids_of(t), 1] for d, t in texts.items()}
    seen, places = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(whole[r["doc_id"]], dtype="<u4")
        assert r["doc_tokens"] == len(ids)
        assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen.keys() == whole.keys()
    for d, parts in seen.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(whole[d])
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(map(len, whole.values()))
    assert len(places) == -(-total // 256)  # only the last sequence is padded
    return rows


def test_pack_awkward_rows(spark):
    texts = {r[0]: r[1] for r in odd_rows() if r[0] is not None}
    packed(spark, odd_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(3), texts)
    assert packing.pack(no_docs(spark), PATH).count() == 0
    both = rows_of(packing.pack(odd_docs(spark), PATH))
    assert sum(r["length"] for r in both) == sum(len(ids_of(r[1])) + 1 for r in odd_rows())


@pytest.mark.parametrize("weights", [None, {"hot": 1.0, "s1": 5.0}])
def test_windows_hold_the_mixture(spark, weights):
    draw = random.Random(1)
    texts = {i: " ".join(["word"] * draw.randint(1, 60)) for i in range(900)}
    source = {i: "hot" if i % 2 else f"s{i % 8}" for i in texts}
    docs = spark.createDataFrame([(i, t, source[i]) for i, t in texts.items()], "doc_id long, text string, source string")
    rows = packed(spark, docs.repartition(4), texts, weights=weights)
    by = defaultdict(Counter)
    for r in rows:
        by[r["window"]][r["source_key"]] += r["length"]
    total = sum((c for c in by.values()), Counter())
    named = {s: {"0hot": 1.0, "0s1": 5.0}.get(s, 1.0) if weights else n for s, n in total.items()}
    ends = {s: max(k for k in by if by[k][s]) for s in total}
    for s, n in total.items():
        for k in range(1, min(ends.values())):
            assert abs(by[k][s] - 1024 * named[s] / sum(named.values())) <= 1
