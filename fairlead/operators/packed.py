"""Several values packed in one field: one row per value, with its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.text import let, strip

OPEN, SHUT = "\ue000", "\ue001"
#: What is taken whole: quoted text with doubled quotes, text in round brackets, web addresses. An address ends before
#: white space, a quote, separators that end a word, or separators before another address.
QUOTED = r'"(?:[^"]|"")*"'
BRACKETED = r"\([^()]*\)"
ADDRESS = r'(?i:https?://)[^\s"]*?(?=[,;|]*(?:[\s"]|$)|[,;|]+(?i:https?://))'
SPAN = rf"{QUOTED}|{ADDRESS}|{BRACKETED}"
SEPARATOR = r"[,;|\r\n]|(?<=\s)/(?=\s)"


def split_packed(c: Column, by_address: bool = False) -> Column:
    """The values in a field, in order, as array<string>; null gives an empty array.

    Protected spans are replaced by placeholders (two private-use characters around the span's index; a private-use
    character that the text itself holds is escaped first, so none can be taken for a placeholder), the rest is split
    at separators, and the spans are put back by array lookup. With ``by_address`` an address is a value of its own,
    whatever stands beside it. Blank values are dropped; outer blanks and a pair of enclosing quotes are removed, and
    doubled quotes inside such a pair halved. A quote that is never closed is ordinary text.
    """
    around = F.lit("\n" if by_address else "")
    is_address = lambda s: s.rlike("^(?i:https?://)")

    def masked(text: Column, spans: Column) -> Column:
        """The text with each span as its index between the marks."""
        line = lambda s: F.when(is_address(s), around).otherwise(F.lit(""))
        mark = lambda g, i: F.when(i < F.size(spans), F.concat(g, line(F.get(spans, i)), F.lit(OPEN), i.cast("string"), F.lit(SHUT), line(F.get(spans, i)))).otherwise(g)
        return F.array_join(F.transform(F.split(text, SPAN), mark), "")

    def bare(v: Column) -> Column:
        inner = F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"'))
        return F.replace(strip(F.when(v.rlike(f"(?s)^{QUOTED}$"), inner).otherwise(v)), F.lit(OPEN + "x"), F.lit(OPEN))

    def restored(cell: Column, spans: Column) -> Column:
        atoms = F.regexp_extract_all(cell, F.lit(f"({OPEN}\\d+{SHUT}|[^{OPEN}]+|{OPEN})"), F.lit(1))
        whole = lambda a: F.when(a.rlike(f"^{OPEN}\\d"), F.get(spans, F.regexp_extract(a, r"(\d+)", 1).try_cast("int"))).otherwise(a)
        return F.array_join(F.transform(atoms, whole), "")

    def values(text: Column) -> Column:
        def of(spans: Column) -> Column:
            cells = F.filter(F.transform(F.split(masked(text, spans), SEPARATOR), strip), lambda x: x != "")
            return F.filter(F.transform(cells, lambda x: let(restored(x, spans), bare)), lambda x: x != "")

        return let(F.regexp_extract_all(text, F.lit(f"({SPAN})"), F.lit(1)), of)

    return let(F.regexp_replace(F.coalesce(c, F.lit("")), OPEN, OPEN + "x"), values)


def explode_packed(df: DataFrame, key: str, fields: dict[str, bool], least: int = 2) -> DataFrame:
    """(key, field, pos, item) of each field with ``least`` values or more; pos counts from 1. fields: name -> by_address."""
    lists = F.array(*[F.struct(F.lit(f).alias("field"), split_packed(F.col(f), flag).alias("items")) for f, flag in fields.items()])
    wide = df.select(F.col(key), F.inline(lists)).where(F.size("items") >= least)
    return wide.select(key, "field", F.posexplode("items").alias("at", "item")).select(key, "field", (F.col("at") + 1).alias("pos"), "item")
