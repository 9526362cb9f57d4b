import pytest
from pyspark.sql import functions as F

from fairlead.functions import parse as P
from fairlead.functions import text as X
from fairlead.operators.lookup import hull_key


def apply(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, c {kind}")
    return [r.v for r in rows.orderBy("k").select("k", fn(F.col("c")).alias("v")).collect()]


CASES = [
    (X.strip, ["  a b \t\n", " x ", None, ""], ["a b", "x", "", ""]),
    (X.squash, [" a \n b\t\tc ", None], ["a b c", ""]),
    (X.layout_free, [" a\r\n\tb ", None, " "], ["a b", "", " "]),
    (X.fold_accents, ["Höegh Türkiye", "ﬁn", "é", "Ø", "中"], ["Hoegh Turkiye", "fin", "e", "Ø", "中"]),
    (X.clean_org, ["  Samsung HI (Geoje)  Yard ", None], ["samsung hi yard", ""]),
    (X.vessel_key, ["Höegh  Giant (ex Foo) \"Bar\"", "", None], ["hoegh giant bar", "", ""]),
    (X.split_refs, ["http://a, http://b\nhttp://a,, x", None, " , "], [["http://a", "http://b", "http://a,", "x"], [], []]),
    (X.fold_hyphens, ["H－12‑34"], ["H-12-34"]),
    (X.tri_label, [], []),
    (P.number, ["1,234.5", "1d", "nan", "1_000", "-.5", "1e3", "", None], [1234.5, None, None, None, -0.5, 1000.0, None, None]),
    (P.whole, ["174,000", "174000.5", "", None], [174000, None, None, None]),
    (P.digits, ["174000.0", "IMO 12", None], ["1740000", "12", ""]),
    (P.year, ["due 2027", "1899", None], ["2027", "", ""]),
    (P.date_int, ["3/4/2025 note", "2025-3-4", "12-Foo-2025", "4 Mar 2025", "Mar 2025", "13/32/2025", None], [20250304, 20250304, 20250012, 20250304, None, 20251332, None]),
    (P.month_key, ["2026-03-15", "16-Dec-2025", "Dec 2025", "2026", "3/4/2025", "Foo 2025", None, "2026-3"], ["2026-03", "2025-12", "2025-12", "2026-00", "", "", "", "2026-03"]),
    (P.size_bucket, ["165,000", "175000", "4999", "", None], [160000, 180000, 0, None, None]),
    (P.ordinals, ["Capital Clean ECC 1)", "Geoje 2775", "May 2026", "third ship 4", "9th; unit 3", "CMHI-282-07", None], [[1], [], [], [3, 4], [3, 9], [7], []]),
    (P.id_class, ["9123456", "1157109", "123", "", None], ["real", "synthetic", "other", "blank", "blank"]),
    (P.cell_state, ["x", "UNKNOWN", " ", None], ["value", "unknown", "blank", "blank"]),
    (P.tokens, ["Knutsen OAS of X1", None], [["knutsen", "oas"], []]),
    (hull_key, ["Samsung HI Geoje 2775", "Hudong H2014A", "2775", "Hyundai Samho H8340", None, " "], ["2775", "h2014a", "2775", "h8340", "", ""]),
]


@pytest.mark.parametrize("fn,said,want", [c for c in CASES if c[1]], ids=lambda x: getattr(x, "__name__", None))
def test_function(spark, fn, said, want):
    assert apply(spark, fn, said) == want


def test_tri_label(spark):
    assert apply(spark, X.tri_label, [True, False, None], "boolean") == ["yes", "NO", "?"]


def test_placeholder_parts(spark):
    got = apply(spark, P.placeholder_parts, ["Yard (Owner 1)", "Yard (a (b)", "Hull 12 (Yard)", "(x)", "Real Name", None])
    assert [tuple(g) if g else None for g in got] == [("Yard", "Owner 1"), ("Yard (a", "b"), None, None, None, None]


VARIANTS = {
    "180000": {"180000", "180,000"},
    "252500000": {"252500000", "252,500,000", "252.5m", "$252.5m", "252.5 million", "252m", "$252m", "252 million"},
    "1000000000": {"1000000000", "1,000,000,000", "1000m", "$1000m", "1000 million", "1bn", "$1bn", "1 billion"},
    "Knutsen": {"Knutsen", "knutsen"},
    "7HCG+R4": {"7HCG+R4", "7hcg+r4", "7"},
    "": set(),
}


def test_value_variants(spark):
    assert [set(v) for v in apply(spark, P.value_variants, list(VARIANTS))] == list(VARIANTS.values())


def test_join_refs(spark):
    rows = spark.createDataFrame([("http://a, http://b", ["http://b", "http://c"]), (None, None)], "c string, n array<string>")
    assert [r.v for r in rows.select(X.join_refs(F.col("c"), F.col("n")).alias("v")).collect()] == ["http://a, http://b, http://c", ""]


def test_unescape(spark):
    assert apply(spark, X.unescape_html, ["A &amp;lt; B &lt;c&gt; &#39;"]) == ["A &lt; B <c> '"]
