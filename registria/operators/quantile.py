"""Exact continuous percentiles of money per group, at any group size.

Spark's own exact ``percentile`` keeps all distinct values of a group in one
task. Here each amount falls into a range of amounts, those that agree in number of
digits and in the leading ones. Ranges are counted first; running offsets over them tell which
range holds a rank, and only the amounts of those ranges are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "decimal(38,0)"  # weights may be products of counts, beyond a long
LEADING = 5


def amount_range(value: Column) -> Column:
    """A number that never falls as the amount rises: digits of the cents and the first ``LEADING`` of them.

    There are 90,000 ranges for each power of ten, so a window over the ranges of a group
    has two million rows at most. Amounts below ten billion share theirs with fewer than
    ten million others, larger ones with those of the same leading digits.
    """
    cents = F.abs(value * 100).cast("decimal(20,0)").cast("string")
    size = F.length(cents) * F.lit(10**LEADING) + F.substring(cents, 1, LEADING).cast("int")
    signed = F.when(value < 0, -size).when(value == 0, F.lit(0)).otherwise(size)
    return F.coalesce(signed.cast("long"), F.lit(0).cast("long"))


def _shares(qs: Sequence[str]) -> list[Decimal]:
    shares = [Decimal(q) for q in qs]
    if any(not 0 <= s <= 1 or s != round(s, 10) for s in shares):
        raise ValueError("q must lie between 0 and 1 and have ten decimal places at most")
    return shares


def weighted_percentiles(hist: DataFrame, group: str, value: str, weight: str, qs: Sequence[str]) -> DataFrame:
    """``(group, rows, q, p)``: percentiles with linear interpolation, a row for every group and ``q``.

    ``hist`` holds one row per distinct ``(group, value)``, neither of them null, with the number of
    times it occurs; each ``q`` is a decimal such as ``"0.90"``. Nothing runs until the result is read.
    ``hist`` is mentioned twice; where it ends in an aggregation by group and value, both
    mentions read one exchange.
    """
    places = F.array(*[
        F.struct(F.lit(q).alias("q"), F.lit(end).alias("end"), F.lit(share).cast("decimal(11,10)").alias("share"))
        for q, share in zip(qs, _shares(qs)) for end in ("low", "high")
    ])
    counts = hist.select(
        F.col(group), F.col(value).alias("_value"), F.col(weight).cast(RANK).alias("_n"), amount_range(F.col(value)).alias("_range")
    )
    whole = Window.partitionBy(group)

    def rank(place: Column) -> Column:
        position = (F.col("rows") - 1).cast("decimal(26,0)") * place["share"]
        return F.when(place["end"] == "low", F.floor(position)).otherwise(F.ceil(position)).cast(RANK)

    ranges = (
        counts.groupBy(group, "_range").agg(F.sum("_n").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(whole.orderBy("_range")))
        .withColumn("rows", F.sum("_in").over(whole))
        .withColumn("_before", F.col("_upto") - F.col("_in"))
    )
    # (group, range) that hold a rank, with the ranks in them: two for every q and group at most
    held = ranges.withColumn(
        "_held", F.filter(places, lambda place: (rank(place) >= F.col("_before")) & (rank(place) < F.col("_upto")))
    ).where(F.size("_held") > 0).select(group, "_range", "rows", "_before", "_held")
    upto = F.sum("_n").over(Window.partitionBy(group, "_range").orderBy("_value")) + F.col("_before")
    found = counts.join(held, [group, "_range"]).withColumn("_upto", upto).withColumn(
        "_place",
        F.explode(F.filter("_held", lambda place: (rank(place) >= F.col("_upto") - F.col("_n")) & (rank(place) < F.col("_upto")))),
    )
    amount = F.col("_value").cast("double")
    low, high = (F.max(F.when(F.col("_place.end") == end, amount)) for end in ("low", "high"))
    position = (F.col("rows") - 1).cast("decimal(26,0)") * F.col("_share")
    fraction = (position - F.floor(position)).cast("double")
    return (
        found.groupBy(group, "rows", F.col("_place.q").alias("q"), F.col("_place.share").alias("_share"))
        .agg(low.alias("_low"), high.alias("_high"))
        .select(group, "rows", "q", (F.col("_low") + (F.col("_high") - F.col("_low")) * fraction).alias("p"))
    )


def weighted_percentile(hist: DataFrame, group: str, value: str, weight: str, q: str) -> DataFrame:
    """``(group, rows, p)``: one percentile of ``weighted_percentiles``."""
    return weighted_percentiles(hist, group, value, weight, [q]).drop("q")
