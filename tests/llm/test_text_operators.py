"""Spelling variants, repeated passages, collocations: against plain Python on small awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from registria.llm import collocations, fingerprints, passages, spelling

from .fixtures import SCHEMA, no_docs, odd_docs, odd_rows, rows_of


def clashing(spark, rows):
    """The table with more columns, named as the operators name theirs."""
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr("*", "0 as ord", "'x' as word", "1 as n", "'p' as phrase", "0 as at", "'s' as shard", "1 as length", "'r' as run")


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Fingerprints

def test_scan_finds_the_same_words_as_a_pattern():
    texts = [b"", b" \t", b"one", b"a  b\tc\nd", b"\xc3\xa9\xff x\x0b\x0cy ", b"z" * 3000]
    words = fingerprints.scan(texts, b" \t\n\x0b\x0c\r", b"")
    got = [(int(words.text[i]), words.word(i)) for i in range(len(words.start))]
    assert got == [(k, w) for k, t in enumerate(texts) for w in t.split()]
    prints = defaultdict(set)
    for (_, w), p in zip(got, words.print):
        prints[w].add(int(p))
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)
    assert len(fingerprints.scan([], b" ", b"\n").start) == 0


@pytest.mark.parametrize("n", [1, 2, 5])
def test_grams_are_equal_where_words_are(n):
    draw = random.Random(n)
    seq = [draw.choice(["a", "b", "cc", "ab"]) for _ in range(3000)]
    words = fingerprints.scan([" ".join(seq).encode()], b" ", b"")
    by = defaultdict(set)
    for i, p in enumerate(words.grams(n)):
        by[tuple(seq[i : i + n])].add(int(p))
    assert all(len(p) == 1 for p in by.values()) and len({min(p) for p in by.values()}) == len(by)


@pytest.mark.parametrize("overlap", [0, 3, 19])
def test_segments_share_words(overlap):
    draw = random.Random(1)
    words = [("w" * draw.choice([1, 3, 200])).encode() + str(i).encode() for i in range(2000)]
    text = b"  ".join(words)
    parts = list(fingerprints.segments(text, overlap, 500))
    assert len(parts) > 10
    end = 0
    for first, part in parts:
        inside = part.split()
        assert inside == words[first : first + len(inside)] and first == max(0, end - overlap if end else 0)
        end = first + len(inside)
    assert end == len(words)


# Collocations

def plain_collocations(rows, at_least, top):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) >= 2 and a >= at_least}
        hidden = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if 100 * a >= 80 * counts[p[i : i + k]]}
        rated = []
        for p, a in found.items():
            if p not in hidden:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rated)[:top])]
    return out


PHRASES = [(i, t, lang, "s") for i, (t, lang) in enumerate([
    ("New York is big. New York, NEW YORK! In the end; in the end: in the beginning\nof the end", "en"), ("in the end\tin  the   end", "en"),
    ("Ünd ünd und Und", "de"), ("a b a b a b a b a b", None), ("a b a b", "und"), (". , ; \n", "xx"), (None, "en"), ("", None),
    ("of the end of the end of the end", "en"), ("in the end \x00 in the end \x00", "en"),
] * 2)]


@pytest.mark.parametrize("at_least, top", [(2, 2000), (3, 5), (1, 40)])
def test_collocations(spark, at_least, top):
    rows = [(*r, 0, -1, -1, False, "n") for r in PHRASES] + odd_rows()
    got = Counter(tuple(r.values()) for r in rows_of(collocations.collocations(clashing(spark, rows).repartition(5), at_least, top=top)))
    assert got == Counter(plain_collocations(rows, at_least, top))
    assert collocations.collocations(no_docs(spark)).count() == 0


def test_colliding_fingerprints_change_no_count(spark, monkeypatch):
    """With 3 bits of fingerprint nearly everything collides; counts are by text all the same."""
    whole = fingerprints.mixed
    rows = [(*r, 0, -1, -1, False, "n") for r in PHRASES]
    texts = [r[1].lower().encode() for r in rows if r[1]]
    monkeypatch.setattr(fingerprints, "mixed", lambda h: whole(h) & np.uint64(7))
    words = fingerprints.scan(texts, collocations.BLANKS, collocations.ENDS)
    ids = collocations._word_ids(words)
    spelt = [words.word(i) for i in range(len(ids))]
    assert len(set(words.print)) <= 8 < len(set(spelt))
    assert len(set(zip(ids.tolist(), spelt))) == len(set(spelt)) == len(set(ids.tolist()))
    at = np.flatnonzero(words.whole(2, words.piece))
    first, times = collocations._distinct(at, 2, words.grams(2), ids)
    assert Counter({(spelt[i], spelt[i + 1]): int(c) for i, c in zip(first, times)}) == Counter((spelt[i], spelt[i + 1]) for i in at)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_phrases_are_cut_from_joined_words(n):
    """All phrases at once, as if every one was spelt from its words."""
    texts = [b"in the\t end  of it.; \xc3\xbcnd a", b"", b" \t", b"x y\x00 z\n", b"last words here so it ends"]
    words = fingerprints.scan(texts, collocations.BLANKS, collocations.ENDS)
    at = np.flatnonzero(words.whole(n, words.piece))[::-1]
    got = collocations.Joined(words).phrases(at, n).to_pylist()
    assert got == [b" ".join(words.word(i + j) for j in range(n)) for i in at] and len(got) >= 4
    assert collocations.Joined(fingerprints.scan([b" "], collocations.BLANKS, collocations.ENDS)).phrases(at[:0], n).to_pylist() == []


def test_fingerprints_of_a_length_are_found_once(monkeypatch):
    words = fingerprints.scan([b"a b c d a b c d"], collocations.BLANKS, collocations.ENDS)
    asked, grams = Counter(), fingerprints.Words.grams
    monkeypatch.setattr(fingerprints.Words, "grams", lambda self, n: asked.update([n]) or grams(self, n))
    here = collocations.Prints(["en"], words)
    parts = collocations._passed(here, {k: collocations.Filter(np.full(1, 2**64 - 1, np.uint64)) for k in range(1, 5)})
    assert [int(collocations._admitted(here, n, parts).sum()) for n in range(1, 5)] == [8, 7, 6, 5]
    assert asked == {n: 1 for n in range(1, 5)}


# Repeated passages

def plain_repeats(rows, window):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for doc_id, text, *_ in order:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if (key := tuple(w[i : i + window])) in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passage_rows():
    draw = random.Random(9)
    words = [f"w{i}" for i in range(3000)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    shared, line, rows = [prose(70) for _ in range(4)], prose(21), []
    for i in range(80):
        parts = [prose(draw.randint(0, 40)), shared[i % 4] if i % 3 else line, prose(5), " ".join(shared[(i + 1) % 4].split()[i % 30 : i % 30 + 25])]
        rows.append((200 + i, "\n  ".join(parts), "en", "s"))
    base = prose(400).split()
    for i in range(12):  # near copies, each with a word of its own
        rows.append((300 + i, " ".join(base[: i * 30] + [f"own{i}"] + base[i * 30 :]), "en", "s"))
    rows += [(320, "again " * 300, "en", "s"), (321, "a b c " * 200, "en", "s"), (322, "again " * 25, "en", "s"), (323, " ".join(base[:20]), "en", "s")]
    rows += [(330, prose(30) + " x", "en", "s")] * 3 + [(331, shared[0] + " one", "en", "s"), (331, "zz " + shared[0], "en", "s"), (None, shared[1], "en", "s"), (None, shared[1], None, None)]
    return [(*r, 0, -1, -1, False, "n") for r in rows]


@pytest.mark.parametrize("window, gram", [(20, 6), (5, 2)])
def test_repeated_passages(spark, monkeypatch, window, gram):
    for small, size in (("WINDOWS_PER_SHARD", 60), ("WORDS_PER_TASK", 150), ("BLOCK", 50)):
        monkeypatch.setattr(passages, small, size)  # many shards, and hot ones in several tasks
    rows = passage_rows() + odd_rows()
    got = Counter(tuple(r.values()) for r in rows_of(passages.repeat_digest(clashing(spark, rows).repartition(6), window, gram)))
    assert got == Counter(plain_repeats(rows, window))
    assert passages.repeat_digest(no_docs(spark)).count() == 0


def test_repeats_by_id_and_texts_kept(spark):
    rows = [r for r in passage_rows() if r[0] is not None and r[0] < 330]
    got = rows_of(passages.without_repeats(spark.createDataFrame(rows, SCHEMA)))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == Counter(plain_repeats(rows, 20))
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_long_texts_are_hashed_in_parts(spark, monkeypatch):
    draw = random.Random(2)
    words = [str(draw.randrange(10**6)) for _ in range(90000)]
    rows = [(1, " ".join(words), None, None, 0, 0, 0, False, ""), (2, " ".join(words[30000:70000] + ["x"] + words[:100]), None, None, 0, 0, 0, False, "")]
    assert len(rows[0][1]) > 2 * fingerprints.SEGMENT
    got = Counter(tuple(r.values()) for r in rows_of(passages.repeat_digest(spark.createDataFrame(rows, SCHEMA))))
    assert got == Counter(plain_repeats(rows, 20))


# Spelling variants

def plain_words(rows, at_least):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= at_least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, at_least):
    n = plain_words(rows, at_least)
    form, out = {}, []
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and v != w and one_edit(w, v)] for w in n}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def spelling_rows():
    draw = random.Random(4)
    rows = []
    for base in ("straße", "colour", "aaaaa", "aaaaaa", "abcdefghijkl", "naïveté", "zzzzy", "ababab", "Größe", "letter", "longestwordofall"):
        for _ in range(25):
            word = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                i = draw.randrange(len(word))
                word[i : i + 1] = draw.choice([[], [draw.choice("abzé")], [word[i], draw.choice("abzß")]])
            rows += [" ".join(["".join(word)] * draw.choice([1, 2, 5, 20]))]
    rows.append("x" * 4000 + " " + "x" * 4001)
    return [(i, t, None, None, 0, -1, -1, False, "n") for i, t in enumerate(rows)]


@pytest.mark.parametrize("at_least, frequent", [(3, 64), (1, 3), (1, 0)])
def test_spelling_variants(spark, at_least, frequent):
    rows = spelling_rows() + (odd_rows() if at_least == 3 else [])
    got = Counter(tuple(r.values()) for r in rows_of(spelling.spelling_variants(clashing(spark, rows).repartition(4), at_least, frequent=frequent)))
    assert got == Counter(plain_variants(rows, at_least))
    assert spelling.spelling_variants(no_docs(spark)).count() == 0


@pytest.mark.parametrize("frequent", [0, 3, 64])
def test_lists_to_merge_are_few_and_enough(spark, frequent):
    """A word merges at most one list a place, two of its grams or more survive any edit, and every near word is in a list."""
    words = [w for w in plain_words(spelling_rows(), 1) if len(w) < 100]
    grams = spelling.gram_dictionary(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), frequent)
    assert all(s[:-1] in grams.stems for s in grams.stems if len(s) > 2)  # closed under prefixes
    held = {w: set(grams.lists(w)) for w in words}
    for word in words:
        own = grams.of(word)
        affected = max(sum(at <= i < upto for at, _, upto in own) for i in range(1, len(word) + 1))
        lists = grams.to_merge(word)
        assert 1 <= len(lists) <= len(word) and 0 not in lists and affected <= spelling.LONGEST_GRAM and len(own) - affected >= 2
        assert all(lists & held[v] for v in words if v != word and abs(len(v) - len(word)) <= 1 and one_edit(word, v))
