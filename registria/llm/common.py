"""What several operators share: stored intermediates, source keys, running sums."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Rows that one window of a running sum should hold on average.
ROWS_PER_BUCKET = 4096

# Tables stored since the innermost ``settled`` began.
_on_the_way: ContextVar[list[DataFrame] | None] = ContextVar("on_the_way", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a new one for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="registria-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts lineage, survives lost executors, and lets Spark plan the next joins
    with the size of the files. The table stays until the folder is cleared,
    since frames made from it are lazy.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (made := _on_the_way.get()) is not None:
        made.append(table)
    return table


def dropped(df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that no later step reads."""
    spark = df.sparkSession
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, ``stored``; the tables that it stored on the way are deleted then, so it must hand out none of them."""
    before = _on_the_way.set(made := [])
    try:
        df = make()
    finally:
        _on_the_way.reset(before)
    table = stored(df, name)
    for passed in made:
        dropped(passed)
    return table


def source_key(source: Column) -> Column:
    """A string that is never null and sorts as the source does, nulls last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def shuffle_key(seed: str, doc_id: Column) -> Column:
    """Seeded pseudo-random order of documents: md5 in hex, the same in any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def hex_digits(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Leading hex digits of a shuffle key that cut ``rows`` into buckets."""
    return max(0, math.ceil(math.log(max(rows, 1) / per_bucket, 16)))


def hex_bucket(key: str, rows: int) -> Column:
    """The leading digits of a shuffle key, which cut ``rows`` into buckets of a few thousand."""
    digits = hex_digits(rows)
    return F.substring(key, 1, digits) if digits else F.lit("")


def running(df: DataFrame, group: str, bucket: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of ``group`` that come before.

    ``bucket`` must be monotone in ``order`` and cut each group into buckets of a few
    thousand rows, so that a group holding a third of all rows is many tasks' work.
    One row per bucket then gets the sum of the buckets before it.
    """
    earlier = (Window.unboundedPreceding, -1)
    cut = df.withColumn("_v", value.cast("long")).withColumn("_b", bucket)
    offsets = (
        cut.groupBy(group, "_b").agg(F.sum("_v").alias("_t"))
        .withColumn("_off", F.sum("_t").over(Window.partitionBy(group).orderBy("_b").rowsBetween(*earlier)))
        .select(group, "_b", F.coalesce("_off", F.lit(0)).alias("_off"))
    )
    inside = F.sum("_v").over(Window.partitionBy(group, "_b").orderBy(*order).rowsBetween(*earlier))
    return (
        cut.withColumn("_in", F.coalesce(inside, F.lit(0)))
        .join(offsets, [group, "_b"])
        .withColumn(name, F.col("_in") + F.col("_off"))
        .drop("_v", "_b", "_in", "_off")
    )


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with a number for every row, and the column's name, which no other column has."""
    row = f"_row_{uuid.uuid4().hex}"
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def told_apart(docs: DataFrame, reread: bool) -> tuple[DataFrame, str, str]:
    """``docs`` with a whole number that differs for every row and one for the order of rows; the names of both columns.

    If ``docs`` may be read again (``reread``) and its doc_id are whole numbers, none missing and none given twice, they are that
    number and nothing is copied. Otherwise the rows are stored with numbers of their own, which are their order too.
    """
    if reread and docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or doc_id is null").isEmpty():
            row = f"_row_{uuid.uuid4().hex}"
            return docs.withColumns({row: F.col("doc_id").cast("long"), f"{row}_at": F.monotonically_increasing_id()}), row, f"{row}_at"
    rows, row = numbered(docs)
    return rows, row, row


def one_of_each(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame], group: str, largest: bool = False, reread: bool = False) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest (or largest) id; columns as they are.

    ``grouped`` gets (doc_id, text), with row numbers for ids, and returns ``doc_id`` and the column ``group``. Rows are told
    apart by number: an id given twice with different texts loses neither, and of rows that
    repeat entirely one stays. A row without an id stays only where no row of its group has one.

    Only the numbers of rows that go are kept on disk, next to a copy of the rows if their ids do not tell
    them apart or ``docs`` must not be read again (``reread``). They are stored sorted, which packs them to a few bytes
    a row: up to the broadcast threshold no text is shuffled to drop them.
    """
    rows, row, _ = told_apart(docs, reread)

    def gone() -> DataFrame:
        ids = rows.select(F.col(row).alias("_row"), F.col("doc_id").cast("long").alias("_id"))
        found = grouped(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), F.col(group).alias("_group"))
        known, of_id = F.col("_id").isNotNull().cast("int"), F.coalesce("_id", F.lit(0))
        order = F.struct((-known).alias("a"), (-of_id if largest else of_id).alias("b"), F.col("_row").alias("stays"))
        placed = stored(found.join(ids, "_row").select("_row", "_group", order.alias("_o")), "groups")
        best = placed.groupBy("_group").agg(F.min("_o").alias("_m"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return placed.join(best, "_group").where("_row <> _m.stays").select(F.col("_row").alias(row)).sortWithinPartitions(row)

    return rows.join(settled(gone, "gone"), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
