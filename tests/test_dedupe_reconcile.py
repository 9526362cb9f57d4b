import itertools
import random

import pytest
from pyspark.sql import functions as F

from fairlead.operators import dedupe as D
from fairlead.operators import reconcile as R

COLS = "record_id long, row_id string, builder_tag string, owner_tag string, imo_number string, hull_number string, capacity string, delivery_year string, contract_date string, vessel_name string, original_source string"


def keyed(spark, rows):
    return D.keyed_rows(spark.createDataFrame([(k, str(k), *r) for k, r in enumerate(rows)], COLS))


ROWS = [
    ("y", "o", "9123456", "H1", "174000", "2027", "2025-01", "Real One", ""),
    ("y", "o", "9123456", "H2", "174000", "2027", "2025-01", "Real Two", ""),
    ("y", "o", "", "", "174000", "2028", None, "Slot first", ""),
    ("y", "o", None, None, "182001", "2028", None, "Slot second", None),
    ("y", "o", "", "", "174000", "2030", "", "Late slot", ""),
    ("y", "o", "12345", "", "174000", "2027", "", "Short id", ""),
    ("y", "", "", "", "174000", "2027", "", "No owner", ""),
    ("y", "o", "", "", "4000", "2027", "", "Tiny", ""),
    ("y", "o", "", "h1", "", "", "", "Same hull", ""),
]


def brute(rows):
    """Pairs of one block by the plain reading of the rules: (a, b) -> tier."""
    out = {}
    for a, b in itertools.combinations([r for r in rows if r.builder and r.owner and r.bucket], 2):
        if (a.builder, a.owner, a.bucket) != (b.builder, b.owner, b.bucket) or abs(a.size - b.size) > 8000:
            continue
        if a.year and b.year and abs(int(a.year) - int(b.year)) > 1 or not (a.slot or b.slot):
            continue
        out[a.record_id, b.record_id] = 4 if a.marks and b.marks and not set(a.marks) & set(b.marks) else 2
    return out


def test_duplicates(spark):
    k = keyed(spark, ROWS)
    assert sorted((r.kind, r.key, r.record_id) for r in D.shared_key(k, ["imo"], "imo").collect()) == [("imo", "9123456", 0), ("imo", "9123456", 1)]
    assert sorted(r.record_id for r in D.shared_key(k, ["builder", "hull"], "hull").collect()) == [0, 8]
    assert D.index_stats(k).head().asDict() == {"rows": 9, "hull_keys": 2, "order_keys": 1}
    assert [(r.key, r.rows) for r in D.key_index(k, ["builder", "owner", "month"], "order").collect()] == [("y|o|2025-01", 2)]


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_block_links_equal_pairs(spark, seed):
    rows = ROWS
    if seed:
        rng = random.Random(seed)
        rows = [("y", rng.choice("op"), rng.choice(["", "9123456"]), rng.choice(["", "h3"]), rng.choice(["170000", "174000", "166000", "", "178001"]), rng.choice(["2026", "2027", "2029", ""]), "", rng.choice(["first", "second", "x"]), "") for _ in range(60)]
    k = keyed(spark, rows)
    pairs = brute(k.collect())
    want = {}
    for (a, b), tier in pairs.items():
        for i in (a, b):
            want.setdefault(i, [0, 0])[tier == 4] += 1
    assert {r.record_id: [r.tier2_links, r.tier4_links] for r in D.block_links(k).collect()} == want
    focus = k.where("record_id % 3 = 0")
    assert {(r.record_id_a, r.record_id_b): r.tier for r in D.focus_pairs(k, focus).collect()} == {p: t for p, t in pairs.items() if p[0] % 3 == 0 or p[1] % 3 == 0}


ROSTER = "idx long, vessel_name string, ex_names array<string>, size long, year int, tags array<string>, grade string"
SHEET = "pos long, name string, size long, year int, tags array<string>, vessel_type string"


def test_buckets(spark):
    roster = spark.createDataFrame([
        (1, "Alpha", [], 170000, 2020, ["a"], "M"), (2, "New", ["Old (x)"], 170000, 2020, ["a"], "M"), (3, "Typed", None, 1, 1, [], ""), (4, "Nobody", [], 14000, 2020, ["z"], "Other"),
        (5, "Big", [], 170000, 2020, ["z"], "M"), (6, "Lost", [], 170000, 2021, ["q"], None), (7, "Unsized", None, None, None, None, None), (8, None, None, 5, None, None, None),
    ], ROSTER)
    sheet = spark.createDataFrame([
        (10, "ALPHA", 170200, 2020, ["a"], "FSRU"), (11, "old", 1, 2020, ["a"], "FSRU"), (12, "typed", 1, 1, [], "conventional"), (13, "Sought", 171000, 2021, ["q", "r"], "FSRU"), (14, "Unref", None, None, None, "FSRU"), (15, "Other", 9, 9, ["q"], "conventional"),
    ], SHEET)
    got = {(r.bucket, r.idx, r.pos, r.small) for r in R.buckets(roster, sheet).collect()}
    assert got == {("matched", 1, 10, None), ("matched", 2, 11, None), ("reclassify", 3, 12, None), ("manual", 6, 13, None), ("candidate", 4, None, True), ("candidate", 5, None, False), ("candidate", 7, None, True), ("candidate", 8, None, True), ("sheet_only", None, 14, None)}


def test_size_agrees(spark):
    rows = spark.createDataFrame([(170000, 170200), (135000, 136967), (125000, 170000), (None, 5)], "a long, b long")
    assert [r.v for r in rows.select(R.size_agrees(F.col("a"), F.col("b")).alias("v")).collect()] == [True, True, False, None]


@pytest.mark.parametrize("seed", range(3))
def test_suggestions_equal_the_sequential_choice(spark, seed):
    rng = random.Random(seed)
    roster = [(i, f"n{i}", [], rng.choice([170000, 174000, None]), rng.choice([2020, 2022, None]), rng.sample("abc", rng.randint(0, 2)), "") for i in range(25)]
    sheet = [(100 + i, f"n{i}" if i in (3, 8, 9) else f"s{i}", rng.choice([170000, 175000, 171000]), rng.choice([2020, 2021, 2023]), rng.sample("abc", rng.randint(0, 2)), "FSRU") for i in range(30)]
    r, s = spark.createDataFrame(roster, ROSTER), spark.createDataFrame(sheet, SHEET)
    named = R.name_join(r, s)
    got = {x.idx: x.pos for x in R.suggest(r, s, named).collect()}
    cell = {x[0]: (tuple(sorted(x[4])), x[2], x[3]) for x in sheet}
    used = {}
    by_name = {x.idx: x.pos for x in named.collect()}
    want = {}
    for i, _, _, size, year, tags, _ in roster:
        if i in by_name:
            used.setdefault(by_name[i], i)
            continue
        open_ = [(abs(year - x[3]) if year else 999, abs(size - x[2])) for x in sheet if size and set(tags) & set(x[4]) and abs(size - x[2]) <= 6000 and x[0] not in used] if size else []
        if not open_:
            continue
        best = min(open_)
        # Of equally good cells any may be taken, so only how good the choice is must agree.
        want[i] = best
        pick = got.get(i)
        assert pick is not None and pick not in used
        x = next(v for v in sheet if v[0] == pick)
        assert (abs(year - x[3]) if year else 999, abs(size - x[2])) == best, cell
        used[pick] = i
    assert set(got) == set(want)


def test_key_buckets_and_differences(spark):
    l = spark.createDataFrame([("1",), ("1 ",), ("2",), (None,), ("5",)], "k string")
    r = spark.createDataFrame([("1",), ("3",), ("",), ("4",)], "k string")
    x = spark.createDataFrame([("1",), ("5",), (None,)], "k string")
    assert {(v.bucket, v.side, v.key, v.rows) for v in R.key_buckets(l, r, x, "k").collect()} == {("contradiction", "both", "1", 3), ("only_left", "left", "2", 1), ("only_left_excluded", "left", "5", 1), ("only_right", "right", "3", 1), ("only_right", "right", "4", 1), ("null_key", "left", "", 1), ("null_key", "right", "", 1)}
    p = spark.createDataFrame([(1, "a", "b", None, " "), (2, "a", "a", "c", "d")], "k int, a1 string, b1 string, a2 string, b2 string")
    assert [(v.k, v.n, v.differences) for v in R.field_differences(p, "k", ["a1", "a2"], ["b1", "b2"], ["one", "two"]).orderBy("k").collect()] == [(1, 1, "one: a | b"), (2, 1, "two: c | d")]


def test_pair_differences(spark):
    p = spark.createDataFrame([(1, 2, 170000, None, 2020, 2020, ["a"], ["b"], "y", "y"), (3, 4, 1, 1, None, 2, [], ["b"], "", "y")], "idx int, pos int, l_size long, r_size long, l_year int, r_year int, l_tags array<string>, r_tags array<string>, l_builder string, r_builder string")
    assert [tuple(r)[2:] for r in R.pair_differences(p).orderBy("idx").collect()] == [(None, True, False, True), (True, None, None, None)]


@pytest.mark.parametrize("seed", range(2))
def test_suggestions_are_the_sequential_rows(spark, seed):
    rng = random.Random(seed)
    roster = [(i, f"n{i}", [], rng.choice([170000, 174000, None]), rng.choice([2020, 2022, None]), rng.sample("abc", rng.randint(0, 2)), "") for i in range(40)]
    sheet = [(100 + i, f"n{i}" if i in (3, 8, 30) else f"s{i}", rng.choice([170000, 174000]), rng.choice([2020, 2021]), rng.sample("abc", rng.randint(0, 2)), "FSRU") for i in range(40)]
    r, s = spark.createDataFrame(roster, ROSTER), spark.createDataFrame(sheet, SHEET)
    named = R.name_join(r, s)
    by_name, used, want = {x.idx: x.pos for x in named.collect()}, set(), {}
    for i, _, _, size, year, tags, _ in roster:
        if i in by_name:
            used.add(by_name[i])
            continue
        open_ = [(abs(year - x[3]) if year else 999, abs(size - x[2]), x[0]) for x in sheet if set(tags) & set(x[4]) and abs(size - x[2]) <= 6000 and x[0] not in used] if size else []
        if open_:
            want[i] = min(open_)[2]
            used.add(want[i])
    assert {x.idx: x.pos for x in R.suggest(r, s, named).collect()} == want
