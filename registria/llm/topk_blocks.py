"""Exact top-k search by inner product: columnar branch-and-bound over dimension blocks."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

CANDIDATES, QUERIES = 8192, 4096  # rows of a cell
TOGETHER = 64  # queries that share the dense rounds
BLOCK = 16  # dimensions of a round
SPARSE = 0.25  # share of survivors from which they are gathered
NARROW = 1 << 28  # components below are kept as 32-bit integers, vectors with larger ones as doubles
MOST = 10**38 - 1


def best_of_wide(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """``best_in_cell`` for components whose scores may pass 63 bits: bounded in floats, decided by Python integers."""
    dims = queries.shape[1]
    q_size, c_size = (max(float(np.abs(x).max(initial=0)), 1.0) for x in (queries, rows))
    columns, c_mass = rows.T / c_size, np.sqrt(((rows / c_size) ** 2).sum(axis=1))
    for i, asked in enumerate(queries):
        scaled = asked / q_size
        about = scaled @ columns
        off = (dims + 4) * 2.0**-52 * float(np.sqrt((scaled**2).sum())) * c_mass + 1e-290  # more than rounding can add
        other = np.flatnonzero(row_ids != query_ids[i])
        ids, at = np.unique(row_ids[other], return_inverse=True)
        least = np.full(len(ids), -np.inf)
        np.maximum.at(least, at, (about - off)[other])
        bound = np.partition(least, -k)[-k] if len(ids) >= k else -np.inf
        whole, best = [int(x) for x in asked], {}
        for j in other[(about + off)[other] >= bound].tolist():
            score = sum(a * int(b) for a, b in zip(whole, rows[j]))
            if (known := best.get(int(row_ids[j]))) is None or score > known[0]:
                best[int(row_ids[j])] = (score, j)
        top = sorted(best.items(), key=lambda item: (-item[1][0], item[0]))[:k]
        yield [i] * len(top), [j for _, (_, j) in top], [score for _, (score, _) in top]


def best_in_cell(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's ``k`` best candidate ids, ties to smaller ids.

    An id with several rows counts once, by its best row, in the bounds and in the result.
    Dimensions are taken in order of the queries' mass. After each block of them a candidate's
    score lies within the remaining masses' product (Cauchy-Schwarz) of what it has; those that cannot
    reach the k-th best lower bound are dropped, and once few are left only they are gathered.
    """
    dims = queries.shape[1]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * dims
    if most >= 2**62 or not dims:
        yield from best_of_wide(queries.astype(float), query_ids, rows.astype(float), row_ids, k)
        return
    order = np.argsort(-(queries.astype(float) ** 2).sum(axis=0), kind="stable")
    kind = np.float64 if most < 2**53 else np.int64
    q, columns = queries[:, order].astype(kind), np.ascontiguousarray(rows[:, order].T.astype(kind))
    cuts = list(range(0, dims, BLOCK)) + [dims]

    def mass(x: np.ndarray) -> np.ndarray:  # of the dimensions after each round: rounds x rows
        squares = np.array([(x[a:b].astype(float) ** 2).sum(axis=0) for a, b in zip(cuts, cuts[1:])])
        return np.sqrt(np.vstack([np.cumsum(squares[::-1], axis=0)[::-1][1:], np.zeros((1, x.shape[1]))]))

    q_mass, c_mass = mass(q.T), mass(columns)
    by_id = np.argsort(row_ids, kind="stable")
    first = np.flatnonzero(np.diff(row_ids[by_id], prepend=row_ids[by_id][:1] - 1))  # of each id
    repeated = len(first) < len(row_ids)

    def best_rows(at_q: np.ndarray, at_c: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Places of every (query, id) at its best value, by query and then from the best value down."""
        if repeated:
            order = np.lexsort((-value, row_ids[at_c], at_q))
            ids, of = row_ids[at_c[order]], at_q[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (ids[1:] != ids[:-1]) | (of[1:] != of[:-1])
            order = order[new]
        else:
            order = np.arange(len(at_q))
        return order[np.lexsort((row_ids[at_c[order]], -value[order], at_q[order]))]

    for begin in range(0, len(q), TOGETHER):
        part = q[begin:begin + TOGETHER]
        own = query_ids[begin:begin + TOGETHER, None] == row_ids[None, :]
        score, at_q, at_c, got = np.zeros((len(part), len(row_ids)), dtype=kind), None, None, None
        for stage, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if at_q is None:
                score += part[:, a:b] @ columns[a:b]
                slack = q_mass[stage, begin:begin + TOGETHER, None] * c_mass[stage][None, :] * (1 + 1e-9) + (b < dims)
                lower = np.where(own, -np.inf, score - slack)
                if repeated:
                    lower = np.maximum.reduceat(lower[:, by_id], first, axis=1)
                least = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(part), -np.inf)
                alive = ~own & (score + slack >= least[:, None])
                if b == dims or alive.mean() < SPARSE:
                    at_q, at_c = np.nonzero(alive)
                    got = score[at_q, at_c]
                continue
            got = got + (part[at_q, a:b] * columns[a:b, at_c].T).sum(axis=1)
            slack = q_mass[stage, begin + at_q] * c_mass[stage, at_c] * (1 + 1e-9) + (b < dims)
            rank = best_rows(at_q, at_c, got - slack)
            starts = np.searchsorted(at_q[rank], np.arange(len(part) + 1))
            least = np.full(len(part), -np.inf)
            for i in np.flatnonzero(np.diff(starts) >= k):
                spot = rank[starts[i] + k - 1]
                least[i] = got[spot] - slack[spot]
            keep = got + slack >= least[at_q]
            at_q, at_c, got = at_q[keep], at_c[keep], got[keep]
        rank = best_rows(at_q, at_c, got)
        place = np.arange(len(rank)) - np.searchsorted(at_q[rank], at_q[rank])
        rank = rank[place < k]
        yield begin + at_q[rank], at_c[rank], got[rank].astype(np.int64)


def _cell(table: pa.Table, k: int) -> pa.Table:
    side = table.column("side").to_numpy()
    ids = table.column("vec_id").to_numpy()
    narrow, dims = table.column("v").is_valid().to_numpy(), table.column("d")[0].as_py()
    values = np.zeros((len(ids), dims), np.int32 if narrow.all() else np.float64)
    for column, at in (("v", narrow), ("w", ~narrow)):
        values[at] = table.column(column).combine_chunks().flatten().to_numpy().reshape(at.sum(), dims)
    asks, has = side == 0, side == 1
    query_ids, vec_ids, scores = [], [], []
    if asks.any() and has.any():
        for i, j, found in best_in_cell(values[asks], ids[asks], values[has], ids[has], k):
            query_ids += ids[asks][i].tolist()
            vec_ids += ids[has][j].tolist()
            scores += [Decimal(max(-MOST, min(MOST, int(x)))) for x in found]
    return pa.table([pa.array(query_ids, pa.int64()), pa.array(vec_ids, pa.int64()), pa.array(scores, pa.decimal128(38, 0))], names=["query_id", "vec_id", "score"])


def vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and whole components floor(scale * x), of the vectors that can take part: ``v``, or ``w`` where one is wide."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    finite = F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # doubles from 2**53 on are whole
    whole = F.transform("s", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    narrow = F.forall("w", lambda x: F.abs(x) < NARROW)
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("s"))
        .where(F.col("vec_id").isNotNull() & F.col("s").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select("vec_id", whole.alias("w"))
        .select("vec_id", F.when(narrow, F.transform("w", lambda x: x.cast("int"))).alias("v"), F.when(~narrow, F.col("w")).alias("w"))
    )


def top_k(table: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for every query, by inner product.

    Queries are the rows whose vec_id is divisible by ``every``; a row is no candidate for its own id.
    Queries and candidates are dealt into a grid of cells of bounded size, each cell is searched by
    itself, and a query's best of all cells follow. Vectors that are null or hold a null, NaN or
    infinite component (256 times it included) take no part, nor do rows without an id; vectors are compared
    with those of equal length only, empty ones too. Scores are compared as whole numbers of up to 38
    digits; one that does not fit a long is returned as the nearest long. A query id that repeats keeps the best of all its vectors,
    and so does a candidate id: it takes one place. Rows with equal id and vector are one row.
    """
    rows = stored(vectors(table).distinct(), "vectors")
    asks = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    total = rows.agg(F.count(F.lit(1)), F.sum((F.pmod("vec_id", F.lit(every)) == 0).cast("long"))).first()
    cs, qs = max(1, -(-total[0] // CANDIDATES)), max(1, -(-(total[1] or 0) // QUERIES))
    spread = F.xxhash64("vec_id", "v", "w")
    left = asks.withColumn("q", F.pmod(spread, F.lit(qs))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cs - 1))))
    right = rows.withColumn("c", F.pmod(spread, F.lit(cs))).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(qs - 1))))

    def side(frame: DataFrame, number: int) -> DataFrame:
        return frame.select(F.col("c").cast("long").alias("c"), F.col("q").cast("long").alias("q"), F.size(F.coalesce(F.col("v").cast("array<double>"), "w")).alias("d"),
                            F.lit(number).alias("side"), "vec_id", "v", "w")

    found = (
        side(left, 0).union(side(right, 1)).groupBy("c", "q", "d")
        .applyInArrow(lambda cell: _cell(cell, k), "query_id long, vec_id long, score decimal(38,0)")
    )
    # equal (query, candidate) pairs come from repeated ids: the best one counts
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ends = [F.lit(Decimal(x)).cast("decimal(38,0)") for x in (2**63 - 1, -(2**63))]
    score = F.greatest(F.least("score", ends[0]), ends[1]).cast("long")
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as c from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.c, v.c)::bigint as score
      from v q join v on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p) where rank <= 5
"""
