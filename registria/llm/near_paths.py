"""MinHash near-dedup: chosen-path set similarity join, exact links, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import dropped, one_of_each, stored
from .components import LEAST_TASKS, components
from .tokens import slices
from .toxicity import HELD_BYTES, sliced

WORDS = 5  # of a shingle
COORDINATES = 64  # minwise tokens kept of a set
TREES = 6
ROOT_PATHS = 2  # coordinates that a tree's root branches on
NODE_PATHS = 4  # coordinates that a large node branches on
SMALL_NODE = 256
DEPTH = 4  # nodes still large after so many branchings are one cluster
LIKELY = 32  # equal coordinates, of 64, from which a pair is worth checking
CELL_SHINGLES = 2_000_000  # shingles of a cluster that one task compares
ROW_SHINGLES = 200  # what a set counts besides its shingles
ROWS_PER_TASK = 50_000  # paths, of a level of the trees

_draw = np.random.default_rng(20240229)
_BYTE = _draw.integers(0, 2**63, 256, dtype=np.uint64) * 2 + 1
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_TURN = _draw.integers(0, 2**63, WORDS, dtype=np.uint64) * 2 + 1
_SEEDS = _draw.integers(0, 2**63, COORDINATES, dtype=np.uint64) * 2 + 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct word shingles of every text.

    Words are cut at ASCII white space after lower-casing A-Z. A text of one to four words is
    one shingle; one without words has none.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    blank = _SPACE[data]
    is_start = ~blank & np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(is_start)
    if not len(starts):
        return [np.zeros(0, dtype=np.uint64)] * len(texts)
    word = np.cumsum(is_start) - 1
    place = (np.arange(len(data)) - starts[np.maximum(word, 0)]).astype(np.uint64)
    letters = _mixed(_BYTE[data] + place * np.uint64(0x9E3779B97F4A7C15))
    letters[blank] = 0
    words = _mixed(np.add.reduceat(letters, starts))
    first = np.searchsorted(starts, np.concatenate([[0], ends[:-1]]))
    last = np.append(first[1:], len(starts))
    runs = np.zeros(len(words), dtype=np.uint64)  # of the five words from each word on
    for k in range(WORDS):
        runs[:len(words) - k] += _mixed(words[k:] * _TURN[k] + np.uint64(k + 1))
    runs = _mixed(runs)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= WORDS:
            out.append(np.unique(runs[a:b - WORDS + 1]))
        elif b > a:
            short = sum(int(_mixed(words[a + k:a + k + 1] * _TURN[k] + np.uint64(k + 1))[0]) for k in range(b - a))
            out.append(_mixed(np.array([(short + (b - a)) % 2**64], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def min_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens of every set (none is empty), 32 bits each: sets x coordinates."""
    sizes = np.array([len(s) for s in sets])
    starts, flat = np.cumsum(sizes) - sizes, np.concatenate(sets)
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    for i, seed in enumerate(_SEEDS):
        out[:, i] = _mixed(np.minimum.reduceat(flat * seed, starts)) >> np.uint64(32)
    return out


def _texts(frame: pd.DataFrame) -> list[str]:
    return [t if isinstance(t, str) else "" for t in frame["text"]]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in slices(batch.column(1), HELD_BYTES):
            sets = shingle_sets(["" if t is None else t for t in texts])
            full = [s for s in sets if len(s)]
            tokens = iter(min_tokens(full) if full else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(tokens).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "set_id", "tokens"],
            )


def _hashed(values: np.ndarray, *parts: int) -> np.ndarray:
    for p in parts:
        values = _mixed(values + np.uint64((p * 0x9E3779B97F4A7C15 + 1) % 2**64))
    return values


def _branch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Children of nodes: (node, size, set_id, tokens) to (node, parent's size, set_id). A null node is above all roots.

    A node draws the coordinates it branches on from its own number, so all its sets
    branch alike, and a child is the node, the coordinate and the token there.
    """
    for frame in frames:
        tokens = np.frombuffer(b"".join(frame["tokens"]), dtype=np.uint32).reshape(len(frame), COORDINATES)
        if frame["node"].isna().all():
            parents = [(np.full(len(frame), t + 1, dtype=np.uint64), ROOT_PATHS) for t in range(TREES)]
        else:
            parents = [(frame["node"].to_numpy(dtype=np.int64).view(np.uint64), NODE_PATHS)]
        for parent, paths in parents:
            begin, step = _hashed(parent, 11), _hashed(parent, 13) | np.uint64(1)
            for k in range(paths):  # distinct coordinates, as the step is odd
                at = ((begin + np.uint64(k) * step) % np.uint64(COORDINATES)).astype(np.int64)
                child = _hashed(parent + tokens[np.arange(len(frame)), at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 17 + k)
                yield pd.DataFrame({"node": child.view(np.int64), "above": frame["size"].astype("Int64"), "set_id": frame["set_id"]})


class Parts:
    """Connected parts of row numbers: ``of[i]`` is the least row that ``i`` is connected with."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, j: int) -> None:
        low, high = sorted((self.of[i], self.of[j]))
        if low != high:
            self.of[self.of == high] = low

    def apart(self, i: int) -> np.ndarray:
        """Later rows not connected with ``i`` yet."""
        return np.flatnonzero(self.of[i + 1:] != self.of[i]) + i + 1


def _likely(sizes: np.ndarray, tokens: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` whose size allows the similarity and whose tokens suggest it."""
    a, b = sizes[i], sizes[others]
    others = others[(4 * np.minimum(a, b) >= 3 * np.maximum(a, b))]
    return others[(tokens[others] == tokens[i]).sum(axis=1) >= LIKELY]


def _compared(node: np.ndarray, sizes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For rows sorted by node: the first row of the part of its node that each row may be linked with.

    All rows are compared with the row ``gap`` places further on at once, gap by gap, as long as
    some node reaches that far; pairs that are connected already are passed over.
    """
    parts = Parts(len(node))
    for gap in range(1, len(node)):
        i = np.flatnonzero(node[:-gap] == node[gap:])
        if not len(i):
            break
        i = i[parts.of[i] != parts.of[i + gap]]
        a, b = sizes[i], sizes[i + gap]
        i = i[4 * np.minimum(a, b) >= 3 * np.maximum(a, b)]
        for at in i[(tokens[i] == tokens[i + gap]).sum(axis=1) >= LIKELY].tolist():
            begin, end = np.searchsorted(node, node[at], side="left"), np.searchsorted(node, node[at], side="right")
            own = parts.of[begin:end]
            low, high = sorted((parts.of[at], parts.of[at + gap]))
            own[own == high] = low
    return parts.of


def _small_nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every pair of a small node is compared by its tokens; sets that may be linked become a star.

    Frames are sorted by node; the last node of one may go on in the next.
    """

    def stars(frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(frame["tokens"]), dtype=np.uint32).reshape(len(frame), COORDINATES)
        first = _compared(frame["node"].to_numpy(), frame["n"].to_numpy(), tokens)
        more, ids = np.flatnonzero(first != np.arange(len(frame))), frame["set_id"].to_numpy()
        return pd.DataFrame({"a": ids[first[more]], "b": ids[more]})

    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame["node"].to_numpy() == frame["node"].iloc[-1]
        rest = frame[last].reset_index(drop=True)
        if not last.all():
            yield stars(frame[~last].reset_index(drop=True))
    if rest is not None:
        yield stars(rest)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * |x and y| >= 75 * |x or y|, on sorted sets."""
    if 4 * min(len(x), len(y)) < 3 * max(len(x), len(y)):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= 75 * (len(x) + len(y) - both)


def _verified(frame: pd.DataFrame) -> pd.DataFrame:
    """Links on full sets within a cell of a cluster, as many as its components need.

    A pair that is already connected needs no check. ``side``: 0 compares with all, 1 only with
    rows of side 0. Rows of one non-null ``label`` are known to be connected.
    """
    frame = frame.sort_values(["side", "set_id"]).drop_duplicates("set_id", ignore_index=True)
    ids, sets = frame["set_id"].tolist(), [np.frombuffer(s, dtype=np.uint64) for s in frame["shingles"]]
    sizes, tokens = np.array([len(s) for s in sets]), min_tokens(sets)
    parts, known, out = Parts(len(ids)), {}, []
    for i, label in enumerate(frame["label"]):
        if label is not None:
            parts.join(known.setdefault(label, i), i)
    first = int((frame["side"] == 0).sum())
    for i in range(first):
        for j in _likely(sizes, tokens, i, parts.apart(i)):
            if parts.of[i] != parts.of[j] and linked(sets[i], sets[j]):
                parts.join(i, j)
                out.append((ids[i], ids[j]))
    return pd.DataFrame({"a": [p[0] for p in out], "b": [p[1] for p in out]})


PAIR = "a binary, b binary"


def candidate_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) between sets that may be similar: enough to connect all that are.

    ``TREES`` trees branch the sets by minwise tokens, each root on ``ROOT_PATHS`` coordinates. A node
    of two or more sets, up to ``SMALL_NODE``, is compared exhaustively in one task; a larger one branches
    again on ``NODE_PATHS`` coordinates. Two sets of similarity 0.75 part at a root path with
    probability 0.25, and at a large node's with (0.25 + 0.75 m) ** 4 = m, about 0.004; all twelve
    root paths miss them with less than one in ten million. A large node that keeps three quarters or
    more of its parent's sets is not told apart by branching, as a group of near copies is not: it becomes
    one cluster (a star of links), which costs checks but loses nothing. So does one still large at ``DEPTH``.
    """
    spark = sets.sparkSession
    lean = sets.select("set_id", "n", "tokens")
    found, level, temporary = [], lean.select(*[F.lit(None).cast("long").alias(c) for c in ("node", "size")], "set_id", "tokens"), []
    for depth in range(1, DEPTH + 1):
        paths = stored(level.mapInPandas(_branch, "node long, above long, set_id binary"), "paths")
        temporary.append(paths)
        tasks = max(LEAST_TASKS, -(-paths.count() // ROWS_PER_TASK))  # deep levels have few rows
        dense = (F.lit(depth == DEPTH) | (4 * F.col("size") >= 3 * F.col("above"))) & (F.col("size") > SMALL_NODE)
        full = stored(
            paths.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("set_id").alias("head"), F.min("above").alias("above"))
            .where("size > 1").select("node", "size", "head", F.coalesce(dense, F.lit(False)).alias("dense"))
            .coalesce(tasks),
            "nodes",
        )
        temporary.append(full)
        small = paths.drop("above").join(full.where(F.col("size") <= SMALL_NODE), "node").select("node", "set_id").join(lean, "set_id")
        found.append(stored(
            small.repartition("node").coalesce(tasks).sortWithinPartitions("node", "set_id").mapInPandas(_small_nodes, PAIR), "near-links"))
        members = paths.drop("above").join(full.where(F.col("size") > SMALL_NODE), "node")
        found.append(stored(
            members.where("dense and set_id <> head").select(F.col("head").alias("a"), F.col("set_id").alias("b")).distinct().coalesce(tasks),
            "near-links"))
        if full.where((F.col("size") > SMALL_NODE) & ~F.col("dense")).isEmpty():
            break
        level = members.where("not dense").join(lean.select("set_id", "tokens"), "set_id").select("node", "size", "set_id", "tokens")
    for table in temporary:
        dropped(table)
    links = spark.createDataFrame([], PAIR)
    for part in found:
        links = links.union(part)
    return links.distinct()


def _shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = _texts(frame)
        for a, b in sliced(texts, HELD_BYTES):
            sets = [s.tobytes() for s in shingle_sets(texts[a:b])]
            yield pd.DataFrame({
                "set_id": [hashlib.md5(s).digest() for s in sets], "shingles": sets,
                "want": frame["want"].to_numpy()[a:b], "cluster": frame["cluster"].to_numpy()[a:b],
            }).query("set_id == want").drop(columns="want")


def _with_pivot(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        hit = [
            linked(np.frombuffer(s, dtype=np.uint64), np.frombuffer(p, dtype=np.uint64))
            for s, p in zip(frame["shingles"], frame["pivot_shingles"])
        ]
        yield pd.DataFrame({"a": frame["pivot"], "b": frame["set_id"]})[hit]


def verified_links(docs: DataFrame, sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links (a, b) confirmed on full sets: enough to connect all that are linked.

    Candidate links are first joined to clusters, and the texts of clustered sets (one per set)
    are read again. A cluster of up to ``CELL_SHINGLES`` is checked in one task. A larger one is first
    checked against a few of its own members (the pivots), which usually connects it. Only what the
    largest connected part leaves over is then compared with the whole cluster, in cells of bounded
    size: one side is the rest, the other a slice of the cluster.
    """
    clusters = stored(components(candidates).select(F.col("node").alias("set_id"), F.col("component").alias("cluster")), "clusters")
    wanted = clusters.join(sets.select("set_id", "doc_id", "n"), "set_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    full = stored(
        texts.join(wanted.select("doc_id", "cluster", F.col("set_id").alias("want")), "doc_id")
        .mapInPandas(_shingles, "set_id binary, shingles binary, cluster binary"),
        "shingles",
    )
    mass = clusters.join(sets.select("set_id", "n"), "set_id").groupBy("cluster").agg(F.sum(F.col("n") + ROW_SHINGLES).alias("mass"))
    whole = full.join(mass.where(F.col("mass") <= CELL_SHINGLES), "cluster")
    plain = [F.lit(0).alias("side"), F.lit(None).cast("binary").alias("label")]
    found = stored(
        whole.select("cluster", "set_id", "shingles", *plain).groupBy("cluster").applyInPandas(_verified, PAIR), "links"
    )
    large = stored(mass.where(F.col("mass") > CELL_SHINGLES), "large")
    if large.isEmpty():
        return found
    members = full.join(large, "cluster")
    pivots = (
        members.groupBy("cluster", F.pmod(F.xxhash64("set_id"), F.lit(4)).alias("_p")).agg(F.min("set_id").alias("pivot")).drop("_p")
    )
    pivot_sets = pivots.join(full.select(F.col("set_id").alias("pivot"), F.col("shingles").alias("pivot_shingles")), "pivot")
    stars = stored(
        members.join(pivot_sets, "cluster").where("set_id <> pivot")
        .select("set_id", "shingles", "pivot", "pivot_shingles").mapInPandas(_with_pivot, PAIR),
        "links",
    )
    parts = components(stars)
    labelled = stored(
        members.select("cluster", "mass", "set_id").join(parts.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumnRenamed("component", "label"),
        "labelled",
    )
    most = labelled.where("label is not null").groupBy("cluster", "label").count().groupBy("cluster").agg(
        F.max(F.struct("count", "label")).alias("_m")).select("cluster", F.col("_m.label").alias("main"))
    slices = F.ceil(F.col("mass") * 2 / CELL_SHINGLES).cast("int")
    cut = labelled.join(most, "cluster", "left").withColumn("k", slices).withColumn(
        "mine", F.pmod(F.xxhash64("set_id"), F.col("k")).cast("int")).withColumn(
        "rest", ~F.coalesce(F.col("label") == F.col("main"), F.lit(False)))
    # a cell (i, j) holds slice i of the rest on side 0 and slice j of the whole on side 1
    rests = cut.where("rest").select("cluster", F.col("mine").alias("i")).distinct()
    side0 = cut.where("rest").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "cluster", F.col("mine").alias("i"), "j", "set_id", F.lit(0).alias("side"), "label")
    side1 = cut.join(rests, "cluster").select("cluster", "i", F.col("mine").alias("j"), "set_id", F.lit(1).alias("side"), "label")
    cells = side0.union(side1).join(full.select("set_id", "shingles"), "set_id")
    rest_links = stored(
        cells.groupBy("cluster", "i", "j").applyInPandas(_verified, PAIR), "links"
    )
    return found.union(stars).union(rest_links)


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.75 or
    more, and a component is what links reach. Equal sets are one node from the start, so groups of
    copies never meet. Links are found by ``candidate_links`` and confirmed by ``verified_links``.

    Null texts and texts without words have no shingle and are linked with nothing. Rows without
    an id get a null component of their own unless their set has ids; they stay. Rows that repeat an id
    and a text are in one component and stay together. An empty table gives an empty result. Only
    doc_id and text are read.
    """
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(lean.mapInArrow(_sketch, "doc_id long, n long, set_id binary, tokens binary"), "sketches")
    sets = stored(
        rows.where("set_id is not null and doc_id is not null").groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("tokens").alias("tokens")),
        "sets",
    )
    links = verified_links(lean, sets, candidate_links(sets))
    parts = stored(components(links), "parts")
    heads = (
        sets.join(parts.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    least = parts.join(sets.select(F.col("set_id").alias("node"), "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = heads.join(least, "component", "left").select("set_id", F.coalesce("least", "doc_id").alias("found"))
    return (
        rows.select("doc_id", F.col("n").alias("n_shingles"), "set_id")
        .join(named, "set_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull()))
    )


def deduplicated(docs: DataFrame, reread: bool = False) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; columns as they are.

    Null texts and texts without words are linked with nothing and stay. Of rows that repeat id and text one
    stays, a row without an id only if its component has none with one. An empty table stays empty.
    If ``docs`` may be read again (``reread``) and its ids tell its rows apart, they are not stored first.
    """
    return one_of_each(docs, near_dedup, "component_id", reread=reread)


ORACLE = r"""
with recursive d as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
             else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as set from d),
n as (select doc_id, len(set)::bigint as n_shingles from s),
e as (select doc_id, unnest(set) as h from s),
p as (select x.doc_id as a, y.doc_id as b, count(*) as shared from e x join e y on x.h = y.h and x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
      where 100 * shared >= 75 * (na.n_shingles + nb.n_shingles - shared)),
u as (select a, b from l union select b, a from l),
r as (select doc_id as x, doc_id as y from documents union select r.x, u.b from r join u on u.a = r.y)
select n.doc_id, n_shingles, c.component_id, n.doc_id = c.component_id as kept
from n join (select x, min(y) as component_id from r group by x) c on c.x = n.doc_id
"""
