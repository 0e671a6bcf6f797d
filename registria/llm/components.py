"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import dropped, stored

LEAST_TASKS, ROWS_PER_TASK = 8, 100_000  # of a round: later ones have few rows and need few tasks


def _pointers(edges: DataFrame, seed: int, tasks: int) -> DataFrame:
    """(node, to): every node's least neighbour, or itself, in a random order of nodes; then that one's."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
    seen = edges.select(F.explode(ends).alias("_e")).select("_e.*")

    def place(c: str):
        return F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("id"))

    nearest = seen.groupBy("node").agg(F.min(place("other")).alias("_m")).select("node", F.least("_m", place("node"))["id"].alias("to"))
    least = stored(nearest.coalesce(tasks), "near")
    far = least.select(F.col("node").alias("to"), F.col("to").alias("far"))
    return stored(least.join(far, "to").select("node", F.col("far").alias("to")), "pointers")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Every round contracts the links: a node goes over to the least of its neighbours in an order drawn
    anew, and on to where that one goes; links then join what their ends have become, and those within
    one node or given twice fall away. Nodes shrink by a constant share in the mean whatever the
    links, so long chains take few rounds, and a round's tasks follow its rows. What nodes became is put together from the last round to the first.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stored(links.where("a <> b").select(*pair).distinct(), "links")
    rounds = []
    while rows := edges.count():
        tasks = max(LEAST_TASKS, -(-2 * rows // ROWS_PER_TASK))
        became = _pointers(edges, len(rounds), tasks)
        rounds.append(became)
        start = became.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        end = became.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        moved = edges.join(start, "a").join(end, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        after = stored(moved.where("a <> b").select(*pair).distinct().coalesce(tasks), "links")
        dropped(edges)
        edges = after
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    labels = rounds.pop()
    while rounds:
        before, later = rounds.pop(), labels.select(F.col("node").alias("to"), F.col("to").alias("end"))
        labels = before.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    labels = stored(labels, "labels")
    least = labels.groupBy("to").agg(F.min("node").alias("component"))
    return labels.join(least, "to").select("node", "component")
