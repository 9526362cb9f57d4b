"""Whether cited pages support the values that cite them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.parse import tokens, value_variants
from fairlead.functions.text import let, split_refs, strip
from fairlead.operators.skew import skew_join

# What titles of error pages contain.
ERROR_TITLES = ["404", "429", "503", "not found", "page not found", "too many requests", "access denied", "forbidden", "temporarily unavailable", "just a moment", "attention required"]


def title_of(html: Column) -> Column:
    return strip(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<title[^>]*>([^<]+)</title>", 1))


def page_fault(status: Column, html: Column) -> Column:
    """'HTTP <status>' or 'soft error: <token>' of a page that cannot support anything; null for others. A page never fetched is HTTP 000."""
    tokens_ = F.array(*[F.lit(t) for t in ERROR_TITLES])
    soft = let(F.lower(title_of(html)), lambda title: F.get(F.filter(tokens_, lambda t: F.contains(title, t)), F.lit(0)))
    code = F.coalesce(status, F.lit("000"))
    return F.when(code != "200", F.concat(F.lit("HTTP "), code)).when(soft.isNotNull(), F.concat(F.lit("soft error: "), soft))


def verify(claims: DataFrame, pages: DataFrame, every: bool = True) -> DataFrame:
    """claims (claim, url, expected array<string>) with ok and reason: all (or any) of expected occur in the page, case aside.

    pages: url, status, html, one row per url; popular urls are salted. A claim whose page is unknown fails as HTTP 000.
    """
    own = skew_join(claims, pages.select("url", "status", "html"), "url", "left")
    missing = let(F.lower(F.coalesce("html", F.lit(""))), lambda low: F.filter("expected", lambda x: ~F.contains(low, F.lower(x))))
    fault = page_fault(F.col("status"), F.col("html"))
    if every:
        failed = F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    else:
        failed = F.when(F.size(missing) == F.size("expected"), F.lit("none of expected"))
    reason = F.coalesce(fault, failed, F.lit("ok"))
    return own.select("claim", "url", (reason == "ok").alias("ok"), reason.alias("reason"))


def corroborate(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """claims (claim, url, value) with ok and reason: some rendering of the value, or every token of a text of two or more, is on the page.

    A blank value has nothing to support and passes.
    """
    own = skew_join(claims.withColumn("v", strip(F.col("value"))), pages.select("url", "status", "html"), "url", "left")
    low = F.lower(F.coalesce("html", F.lit("")))
    shown = let(low, lambda page: F.exists(value_variants(F.col("v")), lambda x: F.contains(page, F.lower(x))))
    words = tokens(F.col("v"))
    by_words = ~F.col("v").rlike(r"^\$?\s*[\d,]") & (F.size(words) >= 2) & let(low, lambda page: F.forall(words, lambda w: F.contains(page, w)))
    fault = page_fault(F.col("status"), F.col("html"))
    reason = F.when(F.col("v") == "", "no value").otherwise(F.coalesce(fault, F.when(shown, "ok").when(by_words, "ok: all words").otherwise("value not on page")))
    return own.select("claim", "url", reason.isin("no value", "ok", "ok: all words").alias("ok"), reason.alias("reason"))


def supported_url(checked: DataFrame) -> DataFrame:
    """claim and its url where the check passed, null elsewhere."""
    return checked.select("claim", F.when(F.col("ok"), F.col("url")).alias("url"))


def gate_fills(fills: DataFrame, pages: DataFrame) -> DataFrame:
    """fills (fill, value, urls, derivable) after their links were checked.

    kept: links that pass, in order; dead and conflicts count the others. outcome: pass, derived (keeps its value without
    links) or blank (a researched value that lost all links). level: full with two or more links kept, partial with one.
    """
    one = fills.select("fill", "value", "derivable", F.posexplode_outer("urls").alias("pos", "url"))
    asked = one.where(F.col("url").isNotNull()).select(F.struct("fill", "pos").alias("claim"), "url", "value")
    checked = corroborate(asked, pages).select("claim.fill", "claim.pos", "url", "ok", "reason")
    per = checked.groupBy("fill").agg(
        F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("pos", "url")))).alias("k"),
        F.sum((~F.col("ok") & F.col("reason").rlike("^(HTTP|soft error)")).cast("bigint")).alias("dead"), F.sum((F.col("reason") == "value not on page").cast("bigint")).alias("conflicts"),
    )
    kept = F.array_distinct(F.transform(F.coalesce("k", F.array().cast("array<struct<pos:int,url:string>>")), lambda x: x["url"]))
    out = fills.select("fill", "derivable").join(per, "fill", "left").select("fill", "derivable", F.coalesce("dead", F.lit(0)).alias("dead"), F.coalesce("conflicts", F.lit(0)).alias("conflicts"), kept.alias("kept"))
    n = F.size("kept")
    return out.select("fill", "dead", "conflicts", F.array_join("kept", ", ").alias("kept"), F.when(n > 0, "pass").when(F.coalesce("derivable", F.lit(False)), "derived").otherwise("blank").alias("outcome"), F.when(n >= 2, "full").when(n == 1, "partial").otherwise("none").alias("level"))


def ref_verdicts(cells: DataFrame, pages: DataFrame, keep_tokens: tuple[str, ...] = ()) -> DataFrame:
    """Each link of rewritten cells (cell, value, ref, preserve): PASS, SOFT-KEPT (error page of a kept host), DROPPED-unreachable, DROPPED-conflict or PRESERVED."""
    one = cells.select("cell", "value", "preserve", F.posexplode(split_refs(F.col("ref"))).alias("pos", "url"))
    asked = one.select(F.struct("cell", "pos", "preserve").alias("claim"), "url", "value")
    checked = corroborate(asked, pages)
    soft = F.lit(False)
    for t in keep_tokens:
        soft = soft | F.contains("url", F.lit(t))
    verdict = (
        F.when(F.coalesce("claim.preserve", F.lit(False)), "PRESERVED").when(F.col("ok"), "PASS")
        .when(F.col("reason").startswith("HTTP") & soft, "SOFT-KEPT").when(F.col("reason").rlike("^(HTTP|soft error)"), "DROPPED-unreachable").otherwise("DROPPED-conflict")
    )
    return checked.select("claim.cell", "claim.pos", "url", verdict.alias("verdict"))


def dead_links(sheet: DataFrame, refs: list[str], pages: DataFrame) -> DataFrame:
    """(url, cells, fault) of the distinct links in reference columns whose page is faulty; links without a page are left out."""
    links = sheet.select(F.explode(F.concat(*[split_refs(F.col(c)) for c in refs])).alias("url")).where("url rlike '^(?i)https?://'")
    counts = links.groupBy("url").agg(F.count(F.lit(1)).alias("cells"))
    return counts.join(pages.select("url", page_fault(F.col("status"), F.col("html")).alias("fault")).where("fault is not null"), "url").select("url", "cells", "fault")


def title_has(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """labels (claim, url, label): whether the page's title contains the label, upper case and with '-' for blanks."""
    own = skew_join(labels, pages.select("url", "html"), "url", "left")
    flat = lambda c: F.replace(F.upper(c), F.lit(" "), F.lit("-"))
    return own.select("claim", F.contains(flat(title_of(F.col("html"))), flat(F.col("label"))).alias("ok"))
