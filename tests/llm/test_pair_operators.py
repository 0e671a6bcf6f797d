"""Near dedup and top-k search against brute force; the large-node and large-cluster ways too."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from registria.llm import dedup_tree, near_paths, topk_blocks
from registria.llm.components import components

from .fixtures import SCHEMA, no_docs, odd_docs, odd_rows, rows_of


def shingles(text) -> set:
    words = [w.decode("utf-8", "replace") for w in (text or "").encode().lower().split()]
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows: list[tuple]) -> dict:
    sets = {d: shingles(t) for d, t in rows}
    part = {d: d for d in sets}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((top(a), top(b)))
                part[high] = low
    return {d: (len(sets[d]), top(d), top(d) == d) for d in ids}


def near_copies(n: int) -> list[tuple]:
    """A hot group of edited copies, chains of small edits, and texts that share a passage only."""
    draw = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    base, shared, rows = [draw.choice(words) for _ in range(120)], [draw.choice(words) for _ in range(30)], []
    for i in range(n):
        text = list(base)
        for _ in range(draw.randint(0, 3)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i, " ".join(text)))
    chain = [draw.choice(words) for _ in range(100)]
    for i in range(20):
        chain[(i * 7) % 100] = f"c{i}"
        rows.append((1000 + i, " ".join(chain)))
    rows += [(2000 + i, " ".join(shared + [draw.choice(words) for _ in range(40)])) for i in range(30)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_near_dedup(spark, monkeypatch, small):
    if small:  # every node is large, every cluster is cut into cells
        monkeypatch.setattr(near_paths, "SMALL_NODE", 8)
        monkeypatch.setattr(near_paths, "CELL_SHINGLES", 6000)
    rows = near_copies(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows_of(near_paths.near_dedup(docs))}
    assert got == brute(rows)


def test_near_dedup_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    want = brute([r for r in rows if r[0] is not None])
    got = rows_of(near_paths.near_dedup(odd_docs(spark)))
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]
    assert near_paths.near_dedup(no_docs(spark)).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk_blocks, "CANDIDATES", 150)
    monkeypatch.setattr(topk_blocks, "QUERIES", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 40))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + 0.2 * rng.normal(size=40))]) for i in range(600)]
    rows[10] = (10, rows[11][1])
    good = list(rows)
    rows += [(700, None), (701, [1.0, None] + [0.0] * 38), (750, [float("nan")] * 40), (751, [float("inf")] * 40), (None, rows[0][1]), (752, []), (800, [1.0, 2.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows_of(topk_blocks.top_k(table, every=25, k=5))}
    whole = np.array([np.floor(256 * np.array(v)) for _, v in good], dtype=np.int64)
    want = {}
    for q in range(0, 600, 25):
        scores = whole @ whole[q]
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-scores[i], i))[:5]
        want |= {(q, n + 1): (i, int(scores[i])) for n, i in enumerate(order)}
    assert got == want
    assert topk_blocks.top_k(table.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [40, 10000])
def test_top_k_of_repeated_rows(spark, monkeypatch, cell):
    monkeypatch.setattr(topk_blocks, "CANDIDATES", cell)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=40))]) for i in range(120)]
    rows += rows + [rows[7]] * 20  # wholly repeated
    rows += [(i, [float(x) for x in np.float32(2 * rng.normal(size=40))]) for i in (3, 50, *[9] * 60)]  # several vectors of an id
    got = rows_of(topk_blocks.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=50, k=5))
    best = {}
    whole = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows]
    for q, v in whole:
        for i, w in whole:
            if q % 50 == 0 and i != q:
                best[q, i] = max(best.get((q, i), -2**62), int(v @ w))
    want = {}
    for q in (0, 50, 100):
        order = sorted((i for a, i in best if a == q), key=lambda i: (-best[q, i], i))[:5]
        want |= {(q, n + 1): (i, best[q, i]) for n, i in enumerate(order)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got} == want


@pytest.mark.parametrize("big", [2.0**21, 2.0**40, 2.0**50])
def test_top_k_of_wide_vectors(spark, big):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)] + [(60 + i, [float(x) for x in big * rng.normal(size=6)]) for i in range(12)]
    rows += [(1, [big] * 6), (2, [-big] * 6), (2, [-big] * 6), (100, []), (101, []), (102, [])]
    got = rows_of(topk_blocks.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50, k=5))
    whole, best = [(i, [math.floor(256 * x) for x in v]) for i, v in rows], {}
    for q, v in whole:
        for i, w in whole:
            if q % 50 == 0 and i != q and len(v) == len(w):
                best[q, i] = max(best.get((q, i), -2**200), sum(a * b for a, b in zip(v, w)))
    want = {}
    for q in (0, 50, 100):
        order = sorted((i for a, i in best if a == q), key=lambda i: (-best[q, i], i))[:5]
        want |= {(q, n + 1): (i, max(-2**63, min(2**63 - 1, best[q, i]))) for n, i in enumerate(order)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got} == want
    # queries as wide as the rows: exact order beyond a long
    wide = np.array([[math.floor(256 * x) for x in v] for _, v in rows[60:72]], float)
    ids = np.arange(12)
    for i, j, scores in topk_blocks.best_in_cell(wide, ids + 100, wide, ids, 3):
        for a, b, s in zip(i, j, scores):
            assert s == sum(int(x) * int(y) for x, y in zip(wide[a], wide[b]))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(7, 7), (5000, 5000), (1001, 1000)]
    links += [(2000 + rng.randrange(200), 2000 + rng.randrange(200)) for _ in range(120)]
    part: dict[int, int] = {}
    for a, b in links:
        if a != b:
            low, high = sorted((part.setdefault(a, a), part.setdefault(b, b)))
            part = {x: low if y == high else y for x, y in part.items()}
    assert dict(components(spark.createDataFrame(links, "a long, b long")).collect()) == part
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


REPEATS = [(2, "y"), (2, "x"), (3, "x"), (3, "x"), (5, "z"), (None, "z"), (None, "only here"), (None, "only here"), (7, None), (8, ""), (9, "z")]


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup_keeps_one_row_of_each_text(spark, keep):
    rows = [(i, t, None, "s", 0, 0, 0, False, "n") for i, t in REPEATS]
    got = Counter((r["doc_id"], r["text"]) for r in rows_of(dedup_tree.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(4), keep)))
    ends = {"max": [(2, "y"), (3, "x"), (9, "z"), (None, "only here"), (8, "")], "min": [(2, "y"), (2, "x"), (5, "z"), (None, "only here"), (7, None)]}
    assert got == Counter(ends[keep])


def test_near_dedup_keeps_one_row_of_each_component(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(4, base), (4, base + " tail"), (4, "another text of its own altogether"), (6, base), (6, base), (None, base), (None, "no id no link at all here"), (1, None), (1, " ")]
    rows = [(i, t, None, "s", 0, 0, 0, False, "n") for i, t in texts]
    got = Counter((r["doc_id"], r["text"]) for r in rows_of(near_paths.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(4))))
    of_base = [k for k in got if k[1] and k[1].startswith(base)]
    assert len(of_base) == 1 and of_base[0][0] == 4
    assert got - Counter(of_base) == Counter([(4, "another text of its own altogether"), (None, "no id no link at all here"), (1, None), (1, " ")])
