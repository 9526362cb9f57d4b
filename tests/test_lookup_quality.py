import pytest
from pyspark.sql import functions as F

from fairlead.operators import lookup as L
from fairlead.operators import quality as Q
from fairlead.schema import COORDINATES_REF, SHEET_COLUMNS

VOCAB = {"cargo_type": ["membrane", "type C"], "vessel_type": ["conventional", "FSRU"], "propulsion_type": ["X-DF", "steam"], "capacity_units": ["cbm"], "price_currency": ["USD"]}


def one(spark, fn, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, c string")
    return [r.v for r in rows.select("k", fn(F.col("c")).alias("v")).orderBy("k").collect()]


def test_aliases_first_match_wins(spark):
    tag = lambda c: L.first_alias(L.clean_org(c), L.BUILDER_ALIASES)
    assert one(spark, tag, ["HD Hyundai Samho Heavy Industries (Yeongam)", "DSME", "Unknown Yard ", "", None, "COSCO Shipping Heavy Industries (Yangzhou)"]) == ["hyundai-samho", "hanwha-ocean", "unknown yard", "", "", "cosco shipping heavy industries"]
    owner = lambda c: L.first_alias(L.clean_org(c), L.OWNER_ALIASES)
    assert one(spark, owner, ["Mitsui OSK Lines", "Molten Ltd", "Cool Company", "BW LNG"]) == ["mol", "mol", "cool-co", "bw-lng"]


def test_lessors(spark):
    assert one(spark, lambda c: L.lessor_tags(c, L.LESSOR_ALIASES), ["Karpowership, MOL", "Höegh & TLTC and Foo (x)", None]) == [["karmol", "mol"], ["foo", "hoegh", "tltc"], []]


def test_without_automaton():
    find = L._First([("b", "x"), ("ab", "y")])
    find.automaton = None
    assert find("zab") == "x" and find("q") == "q" and find("") == ""


def test_tag_names_keeps_rows(spark):
    rows = spark.createDataFrame([(1, "DSME"), (2, None), (3, "DSME"), (4, "")], "id int, n string")
    assert {r.id: r.t for r in L.tag_names(rows, {("n", "t"): L.BUILDER_ALIASES}).collect()} == {1: "hanwha-ocean", 2: "", 3: "hanwha-ocean", 4: ""}


def test_alias_table_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_ALIASES", 1)
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "ord int, key string, tag string")
    with pytest.raises(ValueError):
        L.alias_list(rows)


def test_derived_facts(spark):
    rows = spark.createDataFrame([(1, "a", "JP", ""), (2, "a", "JP ", "r2"), (3, "a", "", "r3"), (4, "b", "JP", "r"), (5, "b", "TR", ""), (6, "c", None, "r"), (7, "", "X", "r")], "o int, t string, v string, r string")
    got = {r.tag: (r.value, r.ref, r.seen) for r in L.derive_unambiguous(rows, "t", "v", "r", "o").collect()}
    assert got == {"a": ("JP", "r2", 3), "b": ("AMBIGUOUS", "", 2)}


def test_fullest_block_ties_keep_the_first(spark):
    rows = spark.createDataFrame([(1, "y", "a", ""), (2, "y", "b", "c"), (3, "y", "d", "e"), (4, "z", "", None)], "o int, t string, p string, q string")
    assert [(r.tag, r.filled, r.p, r.q) for r in L.fullest_block(rows, "t", ["p", "q"], "o").collect()] == [("y", 2, "b", "c")]


def test_table_first_and_merge(spark):
    cur = spark.createDataFrame([("a", "AMBIGUOUS", "1"), ("b", "X", "")], "tag string, v string, w string")
    der = spark.createDataFrame([("a", "D", "2"), ("c", "E", "3")], "tag string, v string, w string")
    assert {r.tag: (r.v, r.w) for r in L.table_first(cur, der, "tag", ["v", "w"]).collect()} == {"a": ("D", "1"), "b": ("X", ""), "c": ("E", "3")}
    assert {r.tag: (r.v, r.status) for r in L.merge_facts(cur, der, "tag", "v").collect()} == {"a": ("AMBIGUOUS", "differs"), "b": ("X", "kept"), "c": ("E", "added")}
    assert {r.tag: r.v for r in L.merge_facts(cur, der, "tag", "v", overwrite=True).collect()}["a"] == "D"


def sheet_of(spark, *rows):
    cols = ["record_id", *SHEET_COLUMNS]
    return spark.createDataFrame([tuple([k, *[r.get(c) for c in SHEET_COLUMNS]]) for k, r in enumerate(rows, 1)], ", ".join(f"{c} {'long' if c == 'record_id' else 'string'}" for c in cols))


CLEAN = dict(row_id="1", imo_number="9123456", imo_number_ref="http://x", capacity="174,000", capacity_units="cbm", cargo_type="membrane", cargo_type_ref="clarkson", vessel_type="FSRU", yard_location_latitude="35.1", yard_location_longitude="128.6", yard_location_lat_lon_ref="inferred", delivery_year="2027-2028", contract_date="March 2025", price="250", price_currency="USD")
OFFSET = dict(row_id="2", yard_location_latitude="174000", yard_location_longitude="cbm", operator_charterer="steam", delivery_year="X", delivery_year_ref="2027", original_source="http://u", capacity="membrane")


def test_findings(spark):
    rules = Q.cell_rules({c: set(v) for c, v in VOCAB.items()})
    sheet = sheet_of(spark, CLEAN, OFFSET, dict(row_id="3", price="5", contract_date_ref="http://r", yard_location_lat_lon_ref="http://m"))
    found = Q.cell_findings(sheet, rules).unionByName(Q.pair_findings(sheet))
    got = {(r.record_id, r.check_name, r.column_name) for r in found.collect()}
    assert not [g for g in got if g[0] == 1]
    assert {g[1:] for g in got if g[0] == 2} == {
        ("bad-shape", "yard_location_latitude"), ("misplaced-vocab", "yard_location_longitude"), ("bad-shape", "yard_location_longitude"), ("misplaced-vocab", "operator_charterer"), ("bad-shape", "delivery_year"),
        ("misplaced-in-ref", "delivery_year_ref"), ("url-in-value", "original_source"), ("misplaced-vocab", "capacity"), ("bad-shape", "capacity"), ("missing-pair", "capacity_units"),
    }
    assert {g[1:] for g in got if g[0] == 3} == {("missing-pair", "price_currency"), ("orphan-ref", "contract_date_ref"), ("orphan-ref", COORDINATES_REF)}
    assert [r.record_id for r in Q.column_offset(found).collect()] == [2, 3]
    allowed = spark.createDataFrame([("2", "capacity", "", "x")], "row_id string, column_name string, reason string, value string")
    assert found.count() - Q.without_allowed(found, allowed).count() == 2
    assert Q.any_of(found, ["HIGH"]) and not Q.any_of(found.where("severity = 'LOW'"), ["HIGH", "MED"])
    assert Q.cell_findings(sheet.limit(0), rules).count() == 0


def test_lookup_rules(spark):
    sheet = spark.createDataFrame([(1, "1", "a", "JP", "x"), (2, "2", "a", "KR", "x"), (3, "3", "b", "KR", "x"), (4, "4", "c", "", "x"), (5, "5", "d", "KR", "x")], "record_id long, row_id string, tag string, country string, value string")
    facts = spark.createDataFrame([("a", "JP"), ("b", "AMBIGUOUS"), ("c", "JP")], "tag string, value string")
    assert [(r.record_id, r.value) for r in Q.lookup_mismatch(sheet, "tag", facts, "country").collect()] == [(2, "KR")]
    assert [r.tag for r in Q.coverage_gap(sheet, "tag", facts, "owner").collect()] == ["d"]


def test_name_rules(spark):
    names = ["Yard A (Own 1)", "Yard B (Own)", "Yard A (FSRU)", "Hull 3 (Yard A)", "Single (Z)", None]
    sheet = spark.createDataFrame([(k, str(k), n, "o", "y" if k < 4 else "z") for k, n in enumerate(names)], "record_id long, row_id string, vessel_name string, shipowner string, tag string")
    got = {(r.record_id, r.check_name, r.detail) for r in Q.name_findings(sheet, "tag").collect()}
    assert got == {(0, "name-builder-drift", "Yard B"), (1, "name-builder-drift", "Yard A"), (2, "name-builder-drift", "Yard B"), (1, "name-ordinal-gap", "Own")}


def test_latest_rows_and_runs(spark):
    from datetime import date, datetime

    rows = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (2, "a", datetime(2024, 1, 1)), (3, " ", datetime(2024, 1, 2)), (4, None, None), (5, "b", None)], "record_id long, row_id string, loaded_at timestamp")
    assert sorted(r.record_id for r in Q.latest_rows(rows).collect()) == [2, 5]
    days = spark.createDataFrame([(k, "c", d) for k, d in enumerate([date(2024, 1, 1), date(2024, 1, 31), date(2024, 3, 2), date(2024, 3, 2)])], "id int, cl string, d date")
    assert [r.run for r in Q.labelled_runs(days, ["cl"], "d", "id").orderBy("id").collect()] == [1, 1, 2, 2]
