"""Typed readings of text cells, as Column expressions. What cannot be read is null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairlead.functions.text import strip

# Month names, ordinal words, number of days ignored (dates are compared, never computed with).
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
ORDINAL_WORDS = "first second third fourth fifth sixth seventh eighth ninth tenth".split()
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column) -> Column:
    """Float with optional thousands commas."""
    bare = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def whole(c: Column) -> Column:
    """Integer with optional thousands commas; '174000.5' is none."""
    bare = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(bare.rlike(r"^[+-]?\d{1,18}$"), bare.try_cast("bigint"))


def digits(c: Column) -> Column:
    """The digits alone, '' if there are none. '174000.0' thus reads 1740000: keys only, never quantities."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9]", "")


def digits_int(c: Column) -> Column:
    return F.when(digits(c).rlike(r"^\d{1,18}$"), digits(c).try_cast("bigint"))


def year(c: Column) -> Column:
    """The first 19xx or 20xx anywhere, as text; '' if there is none."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"((?:19|20)\d{2})", 1)


def _month_number(name: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(name)), F.lit(0))


def date_int(c: Column) -> Column:
    """M/D/YYYY, YYYY-MM-DD or D-Mon-YYYY at the start of the cell, as y*10000 + m*100 + d; no calendar check, an unknown month name counts 0."""
    s = strip(c)
    part = lambda p, k: F.regexp_extract(s, p, k).try_cast("int")
    us, iso, named = r"^(\d{1,2})/(\d{1,2})/(\d{4})", r"^(\d{4})-(\d{1,2})-(\d{1,2})", r"^(\d{1,2})[-\s]([A-Za-z]{3})[-\s](\d{4})"
    make = lambda y, m, d: (y * 10000 + m * 100 + d).cast("int")
    return (
        F.when(s.rlike(us), make(part(us, 3), part(us, 1), part(us, 2)))
        .when(s.rlike(iso), make(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(s.rlike(named), make(part(named, 3), _month_number(F.regexp_extract(s, named, 2)), part(named, 1)))
    )


def month_key(c: Column) -> Column:
    """'YYYY-MM' of YYYY-MM(-DD), D-Mon-YYYY or Mon YYYY, 'YYYY-00' of a bare year, else ''. M/D/YYYY is not read here."""
    s = strip(c)
    iso, named, short = r"^(\d{4})-(\d{1,2})", r"^\d{1,2}[-\s]([A-Za-z]{3})[-\s](\d{4})", r"^([A-Za-z]{3})\s+(\d{4})"
    month = lambda p: _month_number(F.regexp_extract(s, p, 1))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return (
        F.when(s.rlike(iso), F.concat(F.regexp_extract(s, iso, 1), F.lit("-"), two(F.regexp_extract(s, iso, 2).try_cast("int"))))
        .when(s.rlike(named) & (month(named) > 0), F.concat(F.regexp_extract(s, named, 2), F.lit("-"), two(month(named))))
        .when(s.rlike(short) & (month(short) > 0), F.concat(F.regexp_extract(s, short, 2), F.lit("-"), two(month(short))))
        .when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit("-00")))
        .otherwise("")
    )


def size_bucket(c: Column, width: int = 10_000) -> Column:
    """The digits rounded half-even to ``width``."""
    return (F.bround(digits_int(c) / F.lit(float(width)), 0) * width).cast("bigint")


def ordinals(*texts: Column) -> Column:
    """Distinct ordinal marks in texts, sorted: words, 'Nth', 'ship/vessel/unit/hull/no. N', '-NN', a last number of one or two digits."""
    found = []
    for t in texts:
        t = F.coalesce(t, F.lit(""))
        low = F.lower(t)
        words = F.array(*[F.when(low.rlike(rf"\b{w}\b"), F.lit(k)) for k, w in enumerate(ORDINAL_WORDS, 1)])
        hits = [F.regexp_extract_all(s, F.lit(p), F.lit(1)) for s, p in ((low, r"\b(\d{1,2})(?:st|nd|rd|th)\b"), (low, r"\b(?:ship|vessel|unit|hull|no\.?)\s*[-#]?\s*(\d{1,2})\b"), (t, r"-(\d{2})\b"), (t, r"(?<!\d)(\d{1,2})\s*\)?\s*$"))]
        found += [F.filter(words, lambda x: x.isNotNull()), *[F.transform(h, lambda x: x.cast("int")) for h in hits]]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def placeholder_parts(name: Column) -> Column:
    """struct(label, inner) of 'Label (inner)' by its last bracket; null for other names and for 'Hull ... (...)'."""
    s = strip(name)
    pattern = r"(?s)^(.+)\(([^(]*)\)$"
    label, inner = strip(F.regexp_extract(s, pattern, 1)), strip(F.regexp_extract(s, pattern, 2))
    return F.when(s.rlike(pattern) & (label != "") & ~label.rlike(r"(?i)^hull\b"), F.struct(label.alias("label"), inner.alias("inner")))


def id_class(c: Column) -> Column:
    """real (7 digits from 8 or 9), synthetic (7 digits from 11), other, blank. The id stays text throughout."""
    d = strip(c)
    return F.when(d == "", "blank").when(d.rlike(r"^[89]\d{6}$"), "real").when(d.rlike(r"^11\d{5}$"), "synthetic").otherwise("other")


def compact(c: Column) -> Column:
    """A double as people write it: up to six significant digits, no trailing zeros."""
    whole_digits = F.greatest(F.floor(F.log10(F.greatest(F.abs(c), F.lit(1e-9)))) + 1, F.lit(1))
    places = F.greatest(F.lit(6) - whole_digits, F.lit(0)).cast("int")
    rounded = F.round(c * F.pow(F.lit(10.0), places)) / F.pow(F.lit(10.0), places)
    text = F.call_function("format_number", rounded, F.lit("0.######"))
    return text


def value_variants(c: Column) -> Column:
    """Renderings in which a page may show a value: itself, lower case, and for numbers plain, grouped, in millions and billions."""
    v = strip(c)
    raw = F.regexp_extract(v, r"^\$?\s*([\d,]+(?:\.\d+)?)", 1)
    n = F.replace(raw, F.lit(","), F.lit("")).try_cast("double")
    is_whole = n.isNotNull() & (n == F.floor(n))
    plain = F.when(is_whole, F.call_function("format_number", n, F.lit("0"))).otherwise(n.cast("string"))
    forms = lambda x, tails: [F.concat(F.lit(a), compact(x), F.lit(b)) for a, b in tails]
    million = [("", "m"), ("$", "m"), ("", " million")]
    billion = [("", "bn"), ("$", "bn"), ("", " billion")]
    big = F.when(is_whole & (n >= 1e6), F.array(*forms(n / 1e6, million), *forms(F.bround(n / 1e6, 0), million)))
    huge = F.when(is_whole & (n >= 1e9), F.array(*forms(n / 1e9, billion), *forms(F.bround(n / 1e9, 2), billion)))
    none = F.array().cast("array<string>")
    all_forms = F.concat(F.array(v, F.lower(v)), F.when(n.isNotNull(), F.array(plain)).otherwise(none), F.when(is_whole, F.array(F.call_function("format_number", n, F.lit("#,##0")))).otherwise(none), F.coalesce(big, none), F.coalesce(huge, none))
    return F.array_distinct(F.filter(all_forms, lambda x: x.isNotNull() & (x != "")))


def tokens(c: Column, least: int = 3) -> Column:
    """Runs of letters and digits of at least ``least`` characters, lower case."""
    return F.filter(F.regexp_extract_all(F.lower(strip(c)), F.lit(r"([A-Za-z0-9]+)"), F.lit(1)), lambda x: F.length(x) >= least)


def cell_state(c: Column) -> Column:
    """blank, unknown or value."""
    s = strip(c)
    return F.when(s == "", "blank").when(F.lower(s) == "unknown", "unknown").otherwise("value")
