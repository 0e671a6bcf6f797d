"""Headerless ``;`` files with mixed encodings, NUL bytes and quoted line breaks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.clean import strip_nul
from .content import Content, contents
from .files import literal
from .layouts import DATE_COLUMNS, LAYOUTS, text_schema

CORRUPT = "_malformed"
SOURCE = "source_file"
# Where a record begins: the block its reader took and its number there, counted from any base.
PLACE = ["_block", "_nth"]
# Marks a quoted blank while reading, to tell it from an absent value. No file
# holds this control character as a whole value.
QUOTED_BLANK = "\u0001"


def detect_encoding(chunks: Iterator[bytes]) -> str:
    """``utf-8-sig``, ``utf-8`` or ``latin-1`` from all bytes of a file, given chunk by chunk.

    A character may straddle chunks. Reading ends at the first byte that is not UTF-8.
    """
    seen = Content()
    for chunk in chunks:
        seen += Content.of(chunk)
        if not seen.valid:
            break
    return seen.encoding


def encodings(files: DataFrame) -> DataFrame:
    """``path, encoding`` from all bytes of each file, read by blocks."""
    return contents(files).select("path", "encoding")


def _odd_quotes(text: str) -> Column:
    """1 if a line opens or closes a quoted value without doing both, else 0."""
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2


def _options() -> dict[str, str]:
    return {
        "sep": ";", "quote": '"', "escape": '"', "header": "false", "mode": "PERMISSIVE",
        "emptyValue": QUOTED_BLANK, "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }


def _schema(layout: str) -> T.StructType:
    return T.StructType([*text_schema(layout).fields, T.StructField(CORRUPT, T.StringType())])


def staged_schema(layout: str) -> T.StructType:
    """Columns of ``read_files``."""
    schema = T.StructType([*_schema(layout).fields, T.StructField(SOURCE, T.StringType())])
    for name in PLACE:
        schema = schema.add(name, T.LongType())
    return schema


def _charset(encoding: str) -> str:
    return "ISO-8859-1" if encoding == "latin-1" else "UTF-8"


def _read_lines(spark: SparkSession, layout: str, paths: list[str], encoding: str) -> DataFrame:
    """Files whose records are lines: Spark splits them at will."""
    reader = spark.read.schema(_schema(layout)).options(**_options(), encoding=_charset(encoding))
    return reader.csv([literal(p) for p in paths]).select(
        "*", F.col("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_nth"),
    )


def _placed_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line with its block and place, ``_starts`` (1 if a record begins with it) and ``_record``, its number in the block.

    Each block's lines are read apart, and the number of odd lines before a block tells
    whether it begins inside a quoted value.
    """
    line, block = [SOURCE, "_block"], Window.partitionBy(SOURCE, "_block").orderBy("_pos")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    lines = spark.read.text([literal(p) for p in paths], lineSep="\n").select(
        F.col("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"), "value", _odd_quotes("value").alias("_odd"),
    )
    opening = (
        lines.groupBy(*line).agg(F.sum("_odd").alias("_flips"))
        .select(*line, (F.coalesce(F.sum("_flips").over(_earlier_blocks()), F.lit(0)) % 2).alias("_open"))
    )
    inside = (F.col("_open") + F.coalesce(F.sum("_odd").over(before), F.lit(0))) % 2
    return (
        lines.join(opening, line)
        .withColumn("_starts", F.when(inside == 0, 1).otherwise(0))
        .withColumn("_record", F.sum("_starts").over(block))
    )


def _earlier_blocks():
    return Window.partitionBy(SOURCE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def count_records(spark: SparkSession, paths: list[str], multiline: bool) -> int:
    """Records of files by their lines and quotes alone, without parsing a field; blank lines are none."""
    if multiline:
        return _placed_lines(spark, paths).where("_starts = 1 and value <> ''").count()
    return spark.read.text([literal(p) for p in paths]).where(F.trim("value") != "").count()


def _read_broken(spark: SparkSession, layout: str, paths: list[str], encoding: str) -> DataFrame:
    """Files with line breaks inside quoted values, read by block like any other.

    Spark's own multi-line reader gives a file to one task. Here a line that is a record by itself
    passes through; only the lines of a broken record are brought together.
    """
    line, placed = [SOURCE, "_block"], _placed_lines(spark, paths)
    alone = (F.col("_starts") == 1) & (F.col("_odd") == 0)
    # a block that begins inside a record continues the last one begun before it
    last = F.when(F.col("_record") > 0, F.struct("_block", "_record"))
    owners = (
        placed.groupBy(*line).agg(F.max("_record").alias("_record"))
        .select(*line, F.last(last, ignorenulls=True).over(_earlier_blocks()).alias("_owner"))
    )
    begun = F.when(F.col("_record") > 0, F.struct("_block", "_record")).otherwise(F.col("_owner"))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_pos", "value")))
    joined = (
        placed.where(~alone).join(owners, line).groupBy(SOURCE, begun.alias("_begun"))
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
        .select(SOURCE, "_begun._block", F.col("_begun._record").cast("long").alias("_nth"), "value")
    )
    whole = placed.where(alone).select(SOURCE, "_block", F.col("_record").cast("long").alias("_nth"), "value")
    records = whole.unionByName(joined)
    text = F.col("value")
    if encoding == "latin-1":
        text = F.decode(text.cast("binary"), _charset(encoding))
    parsed = F.from_csv(F.regexp_replace(text, r"\r$", ""), F.lit(_schema(layout).toDDL()), _options())
    return records.where(F.col("value") != "").select(parsed.alias("r"), SOURCE, *PLACE).select("r.*", SOURCE, *PLACE)


def read_alike(spark: SparkSession, layout: str, paths: list[str], encoding: str, multiline: bool) -> DataFrame:
    """Files of one layout, encoding and line rule as text columns, plus malformed text, source and place."""
    raw = (_read_broken if multiline else _read_lines)(spark, layout, paths, encoding)
    dates = DATE_COLUMNS.get(layout, [])
    return raw.select(
        *[_value(name, name in dates).alias(name) for name in LAYOUTS[layout]], CORRUPT, SOURCE, *PLACE
    )


def _value(name: str, is_date: bool) -> Column:
    """A quoted blank is empty text, but NULL in a date column; NUL characters go."""
    blank = F.lit(None if is_date else "").cast("string")
    text = strip_nul(name)
    return F.when(F.col(name) == QUOTED_BLANK, blank).otherwise(F.nullif(text, F.lit("")) if is_date else text)


def read_files(spark: SparkSession, layout: str, profile: list[tuple[str, str, bool]]) -> DataFrame:
    """Files of one layout, each by its own ``(path, encoding, multiline)``."""
    kinds: dict[tuple[str, bool], list[str]] = {}
    for path, encoding, multiline in profile:
        kinds.setdefault((encoding, multiline), []).append(path)
    parts = [read_alike(spark, layout, paths, *kind) for kind, paths in sorted(kinds.items())]
    return reduce(DataFrame.unionByName, parts)
