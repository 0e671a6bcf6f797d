"""Exact dedup, sharding, mixing: against plain Python on small awkward tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from registria.llm import dedup_tree, mixing, sharding

from .fixtures import no_docs, odd_docs, odd_rows, rows_of


@pytest.mark.parametrize("keep", ["max", "min"])
def test_dedup_tree(spark, keep):
    got = rows_of(dedup_tree.exact_dedup(odd_docs(spark).repartition(7), keep=keep))
    groups = defaultdict(list)
    for r in odd_rows():
        groups[r[1] or ""].append(r[0])
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "max" else min)(known) if known else None
        want += [(i, best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert Counter(tuple(r.values()) for r in got) == Counter(want)
    assert dedup_tree.exact_dedup(no_docs(spark)).count() == 0


def test_dedup_tree_levels_do_not_matter(spark):
    docs = odd_docs(spark).repartition(9)
    runs = [sorted(map(str, dedup_tree.exact_dedup(docs, levels=n, bits=b).collect())) for n, b in ((1, 1), (2, 4), (5, 1))]
    assert runs[0] == runs[1] == runs[2]


def test_dedup_tree_moves_runs_between_partners(spark):
    """Every round sends rows by node alone, to the partition of that number, and merges them where they arrive."""
    rows = dedup_tree.digests(odd_docs(spark).repartition(9))
    plan = dedup_tree.merged_runs(rows, levels=3, bits=2)._jdf.queryExecution().executedPlan().toString()
    moves = re.findall(r"Exchange (\w+)\(([^\n]*)", plan)
    assert [kind for kind, _ in moves if kind != "RoundRobinPartitioning"] == ["shufflepartitionidpassthrough"] * 3 + ["hashpartitioning"]
    assert all(", 64)" in by and "digest" not in by for kind, by in moves if kind == "shufflepartitionidpassthrough")
    assert [dedup_tree.tree_levels(n, 4) for n in (1, 16, 17, 256, 4096)] == [1, 1, 2, 2, 3]
    assert dedup_tree.tree_levels(200, 1) == 8


def test_shards_hold_the_mixture(spark):
    docs = spark.range(0, 3000).selectExpr("id as doc_id", "'t' as text", "case when id % 3 = 0 then 'hot' else 's' || (id % 50) end as source")
    placed = rows_of(sharding.interleaved_shards(docs.repartition(5), 24))
    total, by = Counter(r["source_key"] for r in placed), defaultdict(Counter)
    for r in placed:
        by[r["shard"]][r["source_key"]] += 1
    assert {sum(c.values()) for c in by.values()} == {125}
    assert all(abs(c[s] - total[s] / 24) < (8 if total[s] > 100 else 2) for c in by.values() for s in total)


def test_shard_digest(spark):
    got = rows_of(sharding.shard_digest(odd_docs(spark), 24))
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(map(str, got)) == sorted(map(str, rows_of(sharding.shard_digest(odd_docs(spark).repartition(3), 24))))
    assert sharding.shard_digest(no_docs(spark)).count() == 0


def water_level(sizes: dict) -> dict:
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    rest, left, out = 1.5 * sum(sizes.values()), dict(weights), {}
    while True:
        level = rest / sum(left.values()) if left else 0
        full = [s for s in left if left[s] * level > 2 * sizes[s]]
        if not full:
            return out | {s: w * level for s, w in left.items()}
        for s in full:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
            del left[s]


def test_mix(spark):
    sizes, names = Counter(), {}
    for doc_id, text, _, source, *_ in odd_rows():
        key = "1" if source is None else "0" + source
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[key] += n
    target = water_level(sizes)
    got = rows_of(mixing.mix_digest(odd_docs(spark), block=64))
    assert len(got) == len(odd_rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by_target = defaultdict(int)
    for r in got:
        by_target[round(r["target"], 6)] += r["taken"]
    want = defaultdict(int)
    for s, t in target.items():
        want[round(t, 6)] += round(t)
    assert {k: v for k, v in by_target.items() if v} == pytest.approx({k: v for k, v in want.items() if v}, abs=2)
    pieces = rows_of(mixing.mix(odd_docs(spark), block=64))
    assert sum(p["length"] for p in pieces) == sum(r["taken"] for r in got)
    blocks = defaultdict(int)
    for p in pieces:
        blocks[p["slot"], p["source_key"]] += p["length"]
    assert len({slot for slot, _ in blocks}) == len(blocks)  # a slot has one source
    assert all(n <= 64 for n in blocks.values())
    slots = defaultdict(list)
    for p in pieces:
        slots[p["doc_id"]].append((p["slot"], p["length"]))
    for r in got:
        if r["doc_id"] in (None, 103):  # ids that several rows have
            continue
        mine = slots[r["doc_id"]]
        assert r["first_slot"] == min((s for s, _ in mine), default=None) and r["n_pieces"] == len(mine)
        assert r["slot_words"] == sum(s * n for s, n in mine)
    again = rows_of(mixing.mix_digest(odd_docs(spark).repartition(5), block=64))
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_digest(no_docs(spark)).count() == 0


def test_mix_is_even_all_along(spark):
    docs = spark.range(0, 4000).selectExpr("id as doc_id", "repeat('w ', 50) as text", "case when id % 2 = 0 then 'a' else 'b' || (id % 4) end as source")
    slots = sorted((p["slot"], p["source_key"]) for p in rows_of(mixing.mix(docs, block=500)))
    slots = list(dict(slots).items())
    total = Counter(s for _, s in slots)
    for stretch in (slots[:200], slots[100:300], slots[200:]):
        here = Counter(s for _, s in stretch)
        assert all(abs(here[s] / len(stretch) - total[s] / len(slots)) < 0.05 for s in total)


def test_mixed_documents_follow_the_schedule(spark):
    """Rows come in the order of their slots, so every stretch of the mix is near the weights; odd names and rows do no harm."""
    docs = spark.range(0, 3000).selectExpr(
        "id as doc_id", "repeat('w ', 60) as text", "case when id % 3 = 0 then 'hot' else 's' || (id % 4) end as source",
        "'x' as _row", "1 as _words", "2 as _size", "3 as slot", "'k' as source_key", "4 as `a.b`")
    mixed = mixing.mixed_documents(docs.repartition(7), block=120)
    assert mixed.columns == docs.columns
    got = [r["source"] for r in mixed.collect()]
    total = Counter(got)
    for i in range(0, len(got) - 400, 400):
        here = Counter(got[i : i + 400])
        assert all(abs(here[s] / 400 - total[s] / len(got)) < 0.08 for s in total)
    rows = mixing.mixed_documents(odd_docs(spark), block=64)
    taken = {r["doc_id"]: r["taken"] for r in rows_of(mixing.mix_digest(odd_docs(spark), block=64))}
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows.collect()) == sum(
        r["taken"] for r in rows_of(mixing.mix_digest(odd_docs(spark), block=64))) and taken
    assert mixing.mixed_documents(no_docs(spark)).count() == 0
