"""Mixing sources to target weights along a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import hex_bucket, running, settled, shuffle_key, source_key, stored, told_apart

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5, 2, 1)
# The schedule's points are multiples of 2**31 / golden ratio, modulo 2**31.
POINTS = 1 << 31
GOLDEN = 1327217885
CELL_BITS = 15
SLOTS_PER_BUCKET = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, total_share: float = 1.5, most: int = 2, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Adds ``target`` to (source_key, source_size): one row per source.

    Sources in key order weigh ``cycle`` over and over and share ``total_share`` of all
    words. No target exceeds ``most`` times the source; what is above is shared out again
    by weight. With sources ordered by limit / weight, a source is at its limit if and only if
    the rest of the words, shared by the weights from it on, would lift it that far.
    """
    whole, so_far = Window.partitionBy(), Window.orderBy("_ratio", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(c) for c in cycle]), (F.col("_i") % len(cycle) + 1).cast("int"))
    rows = (
        sizes.withColumn("_i", F.row_number().over(Window.orderBy("source_key")) - 1)
        .withColumn("_w", weight.cast("long"))
        .withColumn("_cap", (F.col("source_size") * most).cast("long"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_words", F.sum("source_size").over(whole) * F.lit(float(total_share)))
        .withColumn("_rest", F.col("_words") - F.coalesce(F.sum("_cap").over(so_far), F.lit(0)))
        .withColumn("_wrest", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(so_far), F.lit(0)))
        .withColumn("_full", F.col("_ratio") <= F.col("_rest") / F.col("_wrest"))
    )
    open_words = F.max("_words").over(whole) - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(whole)
    share = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_w") * open_words / open_weight)
    return rows.withColumn("target", share).select("source_key", "source_size", "target", "_cap")


def schedule(plan: DataFrame, slots: int) -> DataFrame:
    """(slot, source_key, rank): the source of every slot and its rank among the source's slots.

    Slot ``i`` is the point ``i * GOLDEN mod 2**31``; the sources cut the range in
    proportion to their ``need``. The cut points are spread over equal cells, so finding a
    slot's source is an equality join whose cells all hold as many slots.
    """
    total = F.sum("need").over(Window.partitionBy()).cast("decimal(38,0)")
    upto = F.sum("need").over(Window.orderBy("source_key")).cast("decimal(38,0)")

    def edge(part: Column) -> Column:
        return F.floor(part.cast("decimal(20,0)") * F.lit(POINTS).cast("decimal(11,0)") / total.cast("decimal(20,0)")).cast("long")

    cuts = (
        plan.where("need > 0")
        .select("source_key", edge(upto - F.col("need")).alias("lo"), edge(upto).alias("hi"))
        .where("hi > lo")
        .withColumn("cell", F.explode(F.sequence(F.shiftright("lo", CELL_BITS), F.shiftright(F.col("hi") - 1, CELL_BITS))))
    )
    points = plan.sparkSession.range(slots).select(
        F.col("id").alias("slot"), (F.col("id") % POINTS * F.lit(GOLDEN) % POINTS).alias("u")
    ).withColumn("cell", F.shiftright("u", CELL_BITS))
    found = points.join(cuts, "cell").where("u >= lo and u < hi").select("slot", "source_key")
    bucket = F.floor(F.col("slot") / SLOTS_PER_BUCKET)
    return running(found, "source_key", bucket, ["slot"], F.lit(1), "rank")


def _pieces(docs: DataFrame, block: int, seed: str, total_share: float, most: int, row: str | None = None) -> DataFrame:
    """The mix's pieces, and a row with a null slot for every document it takes nothing of."""
    lean = stored(
        docs.select(
            "doc_id", source_key(F.col("source")).alias("source_key"),
            shuffle_key(seed, F.col("doc_id")).alias("mix"), word_count(F.col("text")).alias("size"),
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        ),
        "mix-rows",
    )
    sizes = lean.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, total_share, most)
    amount = F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("_cap"))
    plan = stored(
        plan.withColumn("amount", amount).withColumn("need", F.ceil(F.col("amount") / block).cast("long"))
        .withColumn("late", F.coalesce(F.sum("need").over(Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_cap"),
        "mix-plan",
    )
    slots = plan.agg(F.sum("need")).first()[0] or 0
    queue = running(lean, "source_key", hex_bucket("mix", lean.count()), ["mix", "doc_id", "size", "row"], F.col("size"), "at")
    spans = queue.join(plan, "source_key")
    passes = F.array(*[
        F.struct(F.lit(p).alias("pass"), (F.col("at") + F.col("source_size") * p).alias("a"),
                 F.least(F.col("at") + F.col("size") + F.col("source_size") * p, F.col("amount")).alias("b"))
        for p in range(most)
    ])
    blocks = F.expr(f"""flatten(transform(filter(_passes, x -> x.b > x.a), x -> transform(
        sequence(x.a div {block}, (x.b - 1) div {block}),
        k -> struct(x.pass as pass, k as rank, greatest(x.a, k * {block}) - x.a as start,
                    least(x.b, (k + 1) * {block}) - greatest(x.a, k * {block}) as length))))""")
    cut = (
        spans.withColumn("_passes", passes).withColumn("_p", F.explode_outer(blocks))
        .select("row", "doc_id", "size", "source_size", "target", "source_key", "late", "_p.*")
    )
    return (
        cut.join(schedule(plan, slots), ["source_key", "rank"], "left")
        # ranks that the schedule has not reached by its end follow in source order
        .withColumn("slot", F.when(F.col("rank").isNotNull(), F.coalesce("slot", F.lit(slots) + F.col("late") + F.col("rank"))))
        .drop("late", "rank")
    )


def mix(docs: DataFrame, block: int = 1024, seed: str = "mix", total_share: float = 1.5, most: int = 2) -> DataFrame:
    """The mix as pieces of documents: slot, source_key, pass, doc_id, start, length, in words.

    Each source's documents, in a seeded shuffle, form a stream of words that is cut into
    blocks of ``block`` words; a second pass follows the first if the target asks for more
    than the source holds. Slots of the mix are dealt to sources by a golden-ratio sequence
    through the cumulative targets, and the ``r``-th slot of a source takes its ``r``-th block.
    The last block of a source ends at its target, rounded to a word. Read in order of
    (slot, start of the piece in its stream), every stretch of the mix is near the weights.

    Null texts and texts without words have size 0 and no piece; null sources are one
    source, the last. Rows that repeat an id are separate documents. An empty table gives
    an empty mix. No text is shuffled.
    """
    return _pieces(docs, block, seed, total_share, most).where("slot is not null").drop("row", "size", "source_size", "target")


def mix_digest(docs: DataFrame, block: int = 1024, seed: str = "mix", total_share: float = 1.5, most: int = 2) -> DataFrame:
    """What the mix takes of every document, and where: doc_id, size, source_size, target, taken, first_slot, n_pieces, slot_words.

    ``first_slot`` is the slot in which the document begins (null if the mix does not take it), ``n_pieces``
    the number of its pieces, ``slot_words`` the sum of slot times words over them. A null text has size 0 and
    nothing taken, null sources are one source, rows that repeat are documents of their own, and an empty table
    gives an empty result. Only doc_id, source and text are read.
    """
    pieces = _pieces(docs, block, seed, total_share, most)
    return (
        pieces.groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("taken"), F.min("slot").alias("first_slot"), F.count("slot").alias("n_pieces"),
             F.coalesce(F.sum(F.col("slot") * F.col("length")), F.lit(0)).alias("slot_words"))
        .drop("row")
    )


def mixed_documents(docs: DataFrame, block: int = 1024, seed: str = "mix", total_share: float = 1.5, most: int = 2, reread: bool = False) -> DataFrame:
    """The mix as documents, in the order of the schedule: a row for each pass that takes words of one; columns as they are.

    Rows are sorted over all partitions by the slot in which they begin, so any stretch is near the weights.
    Documents that the mix does not take are absent, so are null texts and texts without
    words. The one at the end of a source's target is
    cut after the words taken (and ``n_chars``, if there is one, is counted again). Null sources are one
    source; rows that repeat are documents of their own; an empty table stays empty.

    If ``docs`` may be read again (``reread``) and its ids tell its rows apart, no text is stored on the way.
    """
    rows, row, at = told_apart(docs, reread)
    words, size, slot = f"{row}_words", f"{row}_size", f"{row}_slot"
    taken = settled(
        lambda: _pieces(rows, block, seed, total_share, most, row).where("slot is not null")
        .groupBy(F.col("row").alias(row), "pass").agg(F.sum("length").alias(words), F.max("size").alias(size), F.min("slot").alias(slot))
        .drop("pass"),
        "mix-taken",
    )
    cut = F.expr(rf"array_join(slice(split(text, '(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])'), 1, cast(`{words}` as int)), '')")
    partial = F.col(words) < F.col(size)
    out = rows.join(taken, row).orderBy(slot, at).withColumn("text", F.when(partial, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(partial, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
with d as (
    select doc_id, case when source is null then '1' else '0' || source end as k,
           md5('mix:' || coalesce(cast(doc_id as varchar), 'null')) as m,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents),
s as (select k, sum(size)::bigint as source_size, 2 * sum(size)::bigint as cap from d group by k),
w as (select *, [5, 2, 1][(row_number() over (order by k) - 1) % 3 + 1] as w from s),
o as (select *, 1.5::double * sum(source_size) over () as words,
             coalesce(sum(cap) over before, 0) as cap_before, sum(w) over () - coalesce(sum(w) over before, 0) as w_from
      from w window before as (order by cap::double / w, k rows between unbounded preceding and 1 preceding)),
f as (select *, cap::double / w <= (words - cap_before) / w_from as is_full from o),
t as (select k, source_size, cap, case when is_full then cap::double else w * (
             words - sum(case when is_full then cap else 0 end) over ()) / sum(case when is_full then 0 else w end) over () end as target
      from f),
q as (select row_number() over () as id, d.*, coalesce(sum(size) over (
          partition by k order by m, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from d),
n as (select k, source_size, target, least(floor(target + 0.5)::bigint, cap) as amount from t),
p as (select *, (amount + 1023) // 1024 as need, coalesce(sum((amount + 1023) // 1024) over (
          order by k rows between unbounded preceding and 1 preceding), 0)::bigint as late, sum((amount + 1023) // 1024) over ()::bigint as slots from n),
c as (select k, late::hugeint * 2147483648 // slots as lo, (late + need)::hugeint * 2147483648 // slots as hi from p where need > 0),
u as (select i as slot, i % 2147483648 * 1327217885 % 2147483648 as u from (select unnest(range((select max(slots) from p))) as i)),
h as (select slot, k, row_number() over (partition by k order by slot) - 1 as rank from u join c on u >= lo and u < hi),
b as (select id, k, late, slots, ahead + source_size * pass as a, least(ahead + size + source_size * pass, amount) as b
      from q join p using (k) cross join (values (0), (1)) as v(pass)),
e as (select id, k, late, slots, a, b, unnest(range(a // 1024, (b - 1) // 1024 + 1)) as rank from b where b > a),
g as (select id, coalesce(slot, slots + late + rank) as slot, least(b, (rank + 1) * 1024) - greatest(a, rank * 1024) as length
      from e left join h using (k, rank)),
z as (select id, sum(length)::bigint as taken, min(slot)::bigint as first_slot, count(*) as n_pieces, sum(slot * length)::bigint as slot_words
      from g group by id)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken, first_slot, coalesce(n_pieces, 0) as n_pieces, coalesce(slot_words, 0) as slot_words
from q join p using (k) left join z using (id)
"""
