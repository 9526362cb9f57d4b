"""Tables and links in HTML pages that were fetched elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.text import fold_hyphens, strip, unescape_html

# The layout of a row of an order table, and the words of types that matter.
ORDER_ROW = (
    r'<tr>\s*<td[^>]*>(\d{1,3})</td>\s*<td[^>]*><a href="(ship\.aspx\?[^"]+)">([^<]+)</a></td>\s*<td[^>]*>([^<]*)</td>\s*'
    r"<td[^>]*>([^<]*)</td>\s*<td[^>]*>([^<]*)</td>\s*<td[^>]*>([^<]*)</td>"
)
RELEVANT, IRRELEVANT = ["lng tanker", "fsru"], ["bunker"]


def order_rows(pages: DataFrame) -> DataFrame:
    """Rows of order tables in pages (yard, html): yard, row_num, ship_token, hull, hull_assigned, typecap, owner, delivery, contract.

    All pages of a yard are read, not the first alone. Entities are unescaped and hyphens folded.
    """
    group = lambda k: F.regexp_extract_all("html", F.lit(ORDER_ROW), F.lit(k))
    names = ["row_num", "link", "hull", "typecap", "owner", "delivery", "contract"]
    rows = pages.select("yard", F.inline(F.arrays_zip(*[group(k).alias(n) for k, n in enumerate(names, 1)])))
    text = lambda n: strip(unescape_html(F.col(n)))
    month = lambda n: F.replace(strip(F.col(n)), F.lit(" "), F.lit(""))
    hull = fold_hyphens(text("hull"))
    return rows.select(
        "yard", F.col("row_num").cast("int").alias("row_num"), F.replace("link", F.lit("ship.aspx?"), F.lit("")).alias("ship_token"), hull.alias("hull"), hull.rlike(r"\d").alias("hull_assigned"),
        text("typecap").alias("typecap"), text("owner").alias("owner"), month("delivery").alias("delivery"), month("contract").alias("contract"),
    )


def relevant_type(c: Column) -> Column:
    low = F.lower(c)
    hit, off = F.lit(False), F.lit(False)
    for w in RELEVANT:
        hit = hit | F.contains(low, F.lit(w))
    for w in IRRELEVANT:
        off = off | F.contains(low, F.lit(w))
    return hit & ~off


def order_filter(rows: DataFrame, relevant: bool = False, since: str | None = None) -> DataFrame:
    """Relevant types, and contracts of month ``since`` (YYYY-MM) or later."""
    if relevant:
        rows = rows.where(relevant_type(F.col("typecap")))
    return rows.where(F.col("contract") >= since) if since else rows


def more_pages(rows: DataFrame, since: str) -> DataFrame:
    """(yard, more): whether a yard's oldest contract on the pages so far is later than the window's start."""
    return rows.where("contract <> ''").groupBy("yard").agg((F.min("contract") > since).alias("more"))


def id_links(pages: DataFrame, pattern: str = r'href="([^"]+)"') -> DataFrame:
    """pages (number, html) with the first link that contains the number, of all links in order without repeats."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))
    return pages.select("number", F.get(F.filter(links, lambda x: F.contains(x, F.col("number"))), F.lit(0)).alias("link"))
