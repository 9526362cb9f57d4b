import pytest
from pyspark.sql import functions as F

from fairlead.operators.packed import explode_packed, split_packed

CASES = [
    ("Trumuntor Gas / / Trorgrungi", False, ["Trumuntor Gas", "Trorgrungi"]),
    ('"Tupela (2009-2021)";Brelgabu (2006, 2018);x/y', False, ["Tupela (2009-2021)", "Brelgabu (2006, 2018)", "x/y"]),
    ("A,B, ,B", False, ["A", "B", "B"]),
    ('"a ""b"" c", d', False, ['a "b" c', "d"]),
    ('say "half, x', False, ['say "half', "x"]),
    ('0, "q, r", ', False, ["0", "q, r", ""]),
    ("n/a", False, ["n/a"]),
    ("one\ntwo\r\nthree|four", False, ["one", "two", "three", "four"]),
    ("https://a.example/z-882272,https://b.example/z-89, register print", True, ["https://a.example/z-882272", "https://b.example/z-89", "register print"]),
    ('"https://a.example/x,y,2.html" https://m.example/@2.5,1.5,14z/d | http://c.example/v?s=1;id=2; analyst\n', True, ["https://a.example/x,y,2.html", "https://m.example/@2.5,1.5,14z/d", "http://c.example/v?s=1;id=2", "analyst"]),
    ("https://u.example/find?q=a|hull&p=4", True, ["https://u.example/find?q=a|hull&p=4"]),
    (None, False, []), ("", True, []), (" , ;", False, []), ('""', False, []),
]


@pytest.mark.parametrize("by_address", [False, True])
def test_split(spark, by_address):
    rows = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES) if c[1] == by_address], "k int, c string")
    got = {r.k: r.v for r in rows.select("k", split_packed(F.col("c"), by_address).alias("v")).collect()}
    assert got == {k: c[2] for k, c in enumerate(CASES) if c[1] == by_address}


def test_explode_counts_from_one_and_needs_two(spark):
    rows = spark.createDataFrame([(1, "a;b;a", "x"), (2, "a", None), (None, "p|q", "")], "record_id long, f string, g string")
    got = sorted(map(tuple, explode_packed(rows, "record_id", {"f": False, "g": False}).collect()), key=str)
    assert got == sorted([(1, "f", 1, "a"), (1, "f", 2, "b"), (1, "f", 3, "a"), (None, "f", 1, "p"), (None, "f", 2, "q")], key=str)


def test_very_long_field(spark):
    rows = spark.createDataFrame([(1, ";".join(f'"v,{k}"' for k in range(20_000)))], "record_id long, f string")
    got = explode_packed(rows, "record_id", {"f": False})
    assert got.count() == 20_000 and got.where("pos = 20000").head().item == "v,19999"


def test_empty_table(spark):
    assert explode_packed(spark.createDataFrame([], "record_id long, f string"), "record_id", {"f": True}).count() == 0
