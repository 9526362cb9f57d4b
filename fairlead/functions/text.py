"""Text functions as Column expressions, JVM-side."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, also where body uses it many times or inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without outer white space of any kind; null becomes ''."""
    return F.coalesce(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def squash(c: Column) -> Column:
    """Stripped, and every run of white space one space."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def layout_free(c: Column) -> Column:
    """Runs of spaces, tabs and line breaks become one space, outer ones go; null becomes ''."""
    return F.coalesce(F.btrim(F.regexp_replace(c, r"[ \t\r\n]+", " ")), F.lit(""))


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From the Unicode database: letters that decompose to one base letter, and those that need more than one."""
    one_from, one_to, more = [], [], []
    for code in range(0xC0, sys.maxunicode + 1):
        ch = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or not ch.isalpha():
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if base == ch or not base or code > 0x2FFF:
            continue
        if len(base) == 1:
            one_from.append(ch)
            one_to.append(base)
        else:
            more.append((ch, base))
    return "".join(one_from), "".join(one_to), tuple(more)


def fold_accents(c: Column) -> Column:
    """Letters without their marks, by compatibility decomposition; letters such as 'ø' that do not decompose stay.

    Letters that decompose to several (ligatures) keep their form unless they are the Latin ones below.
    """
    one_from, one_to, _ = _accents()
    c = F.translate(c, one_from, one_to)
    for ligature, letters in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        c = F.replace(c, F.lit(ligature), F.lit(letters))
    return F.regexp_replace(c, r"\p{M}+", "")


def fold_hyphens(c: Column) -> Column:
    """Full-width and typographic hyphens as '-'."""
    return F.translate(c, "－‐‑﹣", "----")


def clean_org(c: Column) -> Column:
    """Lower case, stripped, bracketed parts removed, white space squashed."""
    return squash(F.regexp_replace(strip(F.lower(c)), r"\([^)]*\)", ""))


def vessel_key(c: Column) -> Column:
    """Name key: accents folded, lower case, bracketed parts and quote marks gone, white space squashed."""
    bare = F.regexp_replace(F.lower(fold_accents(c)), r"\([^)]*\)", " ")
    return squash(F.regexp_replace(bare, "[\"'`]", ""))


def is_ref(name: str) -> bool:
    return name.endswith("_ref")


def looks_url(c: Column) -> Column:
    return c.rlike(r"(?i)https?://")


def split_refs(c: Column) -> Column:
    """A reference cell as its array of links: separated by ', ' or line breaks, in order, repeats kept, blanks gone."""
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r?\n", ", "), ", ")
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def flat_refs(lists: Column) -> Column:
    """Distinct links of an array of reference cells, in order of first appearance."""
    return F.array_distinct(F.flatten(F.transform(lists, split_refs)))


def join_refs(existing: Column, new: Column) -> Column:
    """Ordered union of a cell's links with an array of new ones; existing first."""
    return F.array_join(F.array_distinct(F.concat(split_refs(existing), F.coalesce(F.transform(new, strip), F.array().cast("array<string>")))), ", ")


def tri_label(c: Column) -> Column:
    return F.when(c.isNull(), "?").when(c, "yes").otherwise("NO")


def unescape_html(c: Column) -> Column:
    """The named entities that tables of orders use; '&amp;' last, so nothing is unescaped twice."""
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&eacute;", "é"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(ch))
    return c
