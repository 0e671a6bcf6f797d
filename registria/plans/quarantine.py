"""Rows that break a rule: kept as a table with reason, file and place, and read again once corrected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.quality import violation_reasons
from ..sources import layouts
from ..sources.delimited import CORRUPT, PLACE, SOURCE

COLUMNS = "run_id string, layout string, file string, record long, reasons array<string>, fields array<string>, text string"
KEY = ["file", "record"]


def reasons_of(layout: str, malformed: Column) -> Column:
    """The rules a row of the layout breaks; a malformed row breaks that one."""
    broken = violation_reasons(layouts.REQUIRED.get(layout, []), layouts.WIDTHS[layout])
    return F.when(malformed, F.array(F.lit("malformed"))).otherwise(broken)


def file_name(path: str = SOURCE) -> Column:
    """The base name of a path of file metadata, where names are percent-encoded and a plus is a plus."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def quarantined(staged: DataFrame, layout: str, run_id: str) -> DataFrame:
    """The rows of ``staged`` that are not sound, as the quarantine table has them.

    ``record`` is the number of the record in its file, counted from 1 without blank lines: rows in
    earlier blocks of the file plus the place within the block. Only counts per block are
    put in order, never the rows.
    """
    blocks = staged.groupBy(SOURCE, "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_nth").alias("_first"))
    earlier = Window.partitionBy(SOURCE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select(SOURCE, "_block", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_base"))
    return staged.where(~F.col("sound")).join(begins, [SOURCE, PLACE[0]]).select(
        F.lit(run_id).alias("run_id"), F.lit(layout).alias("layout"), file_name().alias("file"),
        (F.col("_base") + F.col("_nth")).alias("record"), "reasons",
        F.array(*layouts.LAYOUTS[layout]).alias("fields"), F.col(CORRUPT).alias("text"),
    )


def replay(quarantine: DataFrame, corrections: DataFrame, layout: str) -> tuple[DataFrame, DataFrame]:
    """``(sound, rest)``: rows of a layout in quarantine after their corrections (``file, record, fields``).

    A correction takes the place of the row's fields and is judged by the same rules, so ``rest`` holds
    rows without a correction and those that still break a rule, with the new reasons. Of several
    corrections of a row the least counts; those of rows that are not in quarantine do nothing.
    """
    names = list(layouts.LAYOUTS[layout])
    given = corrections.groupBy(*KEY).agg(F.min("fields").alias("_fields"))
    mine = quarantine.where(F.col("layout") == layout).join(given, KEY, "left")
    fits = F.coalesce(F.size("_fields") == len(names), F.lit(False))
    tried = mine.where(F.col("_fields").isNotNull()).withColumns({name: F.get("_fields", F.lit(i)) for i, name in enumerate(names)})
    judged = tried.withColumn("_broken", reasons_of(layout, ~fits))
    again = judged.where(F.size("_broken") > 0).withColumns({"reasons": F.col("_broken"), "fields": F.col("_fields"), "text": F.lit(None).cast("string")})
    rest = mine.where(F.col("_fields").isNull()).select(*quarantine.columns).unionByName(again.select(*quarantine.columns))
    return judged.where(F.size("_broken") == 0).select("file", *names), rest
