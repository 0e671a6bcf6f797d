"""Links in index pages and the choice among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import anti_join
from ..operators.sets import first_per_group
from .layouts import family_of

COMMENT = r"(?s)<!--.*?-->"
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
# An anchor up to its first attribute named href; attributes before it are stepped over whole.
ANCHOR = rf"""(?is)<a(?:\s+(?!href[\s=])[^\s=>"']+(?:\s*=\s*{VALUE})?)*\s+href\s*=\s*{VALUE}"""
LAST = rf"""(?is)\shref\s*=\s*({VALUE})$"""


def hrefs(pages: DataFrame, *keep: str) -> DataFrame:
    """``pos, href`` of every link of every page, with the page columns named in ``keep``."""
    anchors = F.regexp_extract_all(F.regexp_replace("html", COMMENT, ""), F.lit(ANCHOR), 0)
    value = F.regexp_replace(F.regexp_extract("_anchor", LAST, 1), "^[\"']|[\"']$", "")
    return (
        pages.select(*keep, F.posexplode(anchors).alias("pos", "_anchor"))
        .withColumn("href", F.replace(value, F.lit("&amp;"), F.lit("&"))).drop("_anchor").where(F.col("href") != "")
    )


def page_links(
    pages: DataFrame, suffix: str, base: str = "", base_column: str | None = None, max_links: int | None = None
) -> DataFrame:
    """``page_id, pos, link`` for hrefs that end in ``suffix`` (any case).

    Links not starting with ``http`` are taken relative to ``base``, or to the
    page's ``base_column``. ``max_links`` keeps the first links in page order.
    """
    keep = ["page_id", base_column] if base_column else ["page_id"]
    start = F.col(base_column) if base_column else F.lit(base)
    links = (
        hrefs(pages, *keep).where(F.endswith(F.lower("href"), F.lit(suffix.lower())))
        .select(
            "page_id", "pos",
            F.when(F.startswith("href", F.lit("http")), F.col("href"))
            .otherwise(F.concat(start, F.col("href"))).alias("link"),
        )
    )
    return links if max_links is None else links.orderBy("page_id", "pos").limit(max_links)


def newest_month_links(
    pages: DataFrame, root: str, suffix: str = ".zip", max_links: int | None = None
) -> DataFrame:
    """Links of the newest month among stored index pages (``page_id, url, html``).

    The page at ``root`` lists one folder per month; the last in text order that
    starts with ``20`` is the newest, and its page is stored under ``root`` plus
    the folder. No such page or no such link leaves the result empty.
    """
    folders = hrefs(pages.where(F.col("url") == root)).select("href")
    month = latest(folders, "href").select(F.concat(F.lit(root), F.col("href")).alias("url"))
    return page_links(pages.join(month, "url"), suffix, base_column="url", max_links=max_links)


def latest(df: DataFrame, column: str, prefix: str = "20") -> DataFrame:
    """The row with the last value, in text order, among those that start with ``prefix``."""
    row = F.max_by(F.struct(*df.columns), column)
    last = df.where(F.startswith(column, F.lit(prefix))).agg(row.alias("row"))
    return last.where(F.col("row").isNotNull()).select("row.*")


def one_per_family(links: DataFrame, present: DataFrame, link: str = "link", position: str = "pos") -> DataFrame:
    """``family, link``: first link of each file family not among the ``present`` names.

    ``present`` has a ``name`` column. Links of no family are skipped.
    """
    wanted = links.withColumn("family", family_of(link)).where(F.col("family").isNotNull())
    have = present.select(family_of("name").alias("family")).where(F.col("family").isNotNull())
    return anti_join(first_per_group(wanted, "family", link, position), have, "family")
