"""One consistent form of text that looks the same: widths, accents, blanks, invisible and look-alike characters.

The mapping is compiled once per process into a transducer over grapheme clusters: a pattern finds, longest match
first, every cluster that the mapping changes, and a table gives its form. Single characters come from a precomputed
table, checked for conflicts (one source, one target) and closure (a target is never a source); clusters with marks are
composed from it and remembered.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.operators.skew import salted_join
from fairlead.schema import require
from fairlead.session import settle

# Letters of other scripts whose glyphs equal Latin ones.
LOOK_ALIKES = [
    ("АВЕКМНОРСТХІЅЈҮԚԜ", "ABEKMHOPCTXISJYQW"),  # Cyrillic capitals
    ("аеорсухіѕјһԁԛԝ", "aeopcyxisjhdqw"),  # Cyrillic small letters
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),  # Greek capitals
    ("οϲϳ", "ocj"),  # Greek small letters
    ("օɡ", "og"),  # Armenian o, Latin script g
]
# Characters that have no width, other blanks of one space, hyphens drawn as '-'.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
BLANKS = "               　"
HYPHENS = "‐‑−"[:2]


@lru_cache(maxsize=1)
def table() -> dict[str, str]:
    """Character -> its form, for every character of the basic plane that changes."""
    base: dict[str, str] = {}

    def add(source: str, target: str) -> None:
        if base.setdefault(source, target) != target:
            raise ValueError(f"two forms of U+{ord(source):04X}: {base[source]!r} and {target!r}")

    for sources, targets in LOOK_ALIKES:
        for a, b in zip(sources, targets, strict=True):
            add(a, b)
    for ch in [*INVISIBLE, *map(chr, range(0xFE00, 0xFE10))]:
        add(ch, "")
    for ch in BLANKS:
        add(ch, " ")
    for ch in HYPHENS:
        add(ch, "-")
    for ch in map(chr, range(0x110000)):
        kind, _, _ = unicodedata.decomposition(ch).partition(" ")
        compat = kind in ("<wide>", "<narrow>") or kind == "<compat>" and (0xFB00 <= ord(ch) <= 0xFB06 or 0x2160 <= ord(ch) <= 0x217F)
        if compat and ch not in base:
            add(ch, unicodedata.normalize("NFKC", ch))
    full = {}
    for ch in map(chr, range(0x10000)):
        if 0xD800 <= ord(ch) < 0xE000 or 0xAC00 <= ord(ch) <= 0xD7A3:
            continue
        form = _compose(ch, base)
        if form != ch:
            full[ch] = form
    for target in set(full.values()):
        if _compose(target, base) != target:
            raise ValueError(f"{target!r} is a form and has another")
    return full


def _compose(cluster: str, base: dict[str, str]) -> str:
    """Decompose canonically, map each part until nothing changes, compose again."""
    while True:
        parts = unicodedata.normalize("NFD", cluster)
        form = unicodedata.normalize("NFC", "".join(base.get(c, c) for c in parts))
        if form == cluster:
            return form
        cluster = form


def _ranges(chars: list[str]) -> str:
    out, codes = [], sorted(map(ord, chars))
    start = last = codes[0]
    for code in [*codes[1:], None]:
        if code is None or code != last + 1:
            out.append(f"\\U{start:08x}-\\U{last:08x}")
            start = code
        last = code
    return "".join(out)


@lru_cache(maxsize=1)
def _transducer():
    forms = table()
    # Marks: combining characters, and the others that compose with a character before them.
    second = {d[-1] for c in map(chr, range(0x10000)) if not 0xAC00 <= ord(c) <= 0xD7A3 and len(d := unicodedata.normalize("NFD", c)) > 1}
    attached = {c for c in map(chr, range(0x10000)) if unicodedata.combining(c)} | second
    marks = _ranges(sorted(attached))
    hidden = _ranges([c for c, t in forms.items() if t == "" and c not in attached])
    jamo = "[\\u1100-\\u1112][\\u1161-\\u1175][\\u11a8-\\u11c2]?"
    # A base with marks (and invisible characters among them); a Hangul syllable in parts; a line end; one character.
    pattern = re.compile(f"(?s:[^{marks}{hidden}])[{hidden}]*[{marks}][{marks}{hidden}]*|{jamo}|\\r\\n?|[{_ranges([*forms, chr(0x2028), chr(0x2029)])}]")
    memo = {**forms, "\r\n": "\n", "\r": "\n", " ": "\n", " ": "\n"}
    base = {**forms}

    def form(m: re.Match) -> str:
        cluster = m.group()
        known = memo.get(cluster)
        if known is None:
            known = _compose(cluster, base)
            if len(memo) < 200_000:
                memo[cluster] = known
        return known

    return lambda text: pattern.sub(form, text)


def canonical(text: str | None) -> str | None:
    """The one form of a text; null stays null. Case, accents, line breaks and letters that look different stay."""
    if text is None:
        return None
    if text.isascii() and "\r" not in text:
        return text
    return _transducer()(text)


@F.pandas_udf(T.StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore")


def canonical_text(c: Column) -> Column:
    """canonical() on a column, in Arrow batches: clusters and their composition are out of reach of SQL functions."""
    return _canonical_udf(c)


def look_alike_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: texts of one form that are different sequences of characters. Null texts are in no pair.

    Texts themselves are not shuffled: their forms are compared by 256-bit and the texts by 128-bit digests. Only classes
    that hold two different texts are joined, and a class with a large share of the rows is salted.
    """
    rows = require(docs, key, text).where(F.col(text).isNotNull() & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.md5(text).alias("raw"), F.sha2(canonical_text(F.col(text)), 256).alias("form")).distinct()
    rows = settle(rows)  # every text is brought to its form once
    mixed = rows.groupBy("form").agg(F.min("raw").alias("_lo"), F.max("raw").alias("_hi")).where("_lo <> _hi").select("form")
    rows = rows.join(mixed, "form", "left_semi")
    a, b = rows.select("form", F.col("id").alias("doc_id_a"), F.col("raw").alias("_a")), rows.select("form", F.col("id").alias("doc_id_b"), F.col("raw").alias("_b"))
    return salted_join(a, b, "form").where("doc_id_a < doc_id_b and _a <> _b").select("doc_id_a", "doc_id_b").distinct()
