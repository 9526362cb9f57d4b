import json

import pytest
from pyspark.sql import functions as F

from fairlead.operators import gate as G
from fairlead.operators import patch as A
from fairlead.operators import proposals as P
from fairlead.sources import pages as H
from fairlead.sources import sheet as S
from fairlead.sources import sinks as K
from fairlead.streaming import incremental as I


def pages(spark):
    body = lambda title, text: f"<html><head><title>{title}</title></head><body>{text}</body></html>"
    rows = [("u1", "200", body("Ship", "Knutsen gas OAS carrier of 180,000 cbm for $250m")), ("u2", "404", body("Ship", "180,000")), ("u3", "200", body("Just a moment...", "180,000")), ("u4", "200", None)]
    return spark.createDataFrame(rows, "url string, status string, html string")


def test_verify(spark):
    rows = [(1, "u1", ["KNUTSEN", "cbm"]), (2, "u1", ["absent", "cbm"]), (3, "u2", ["cbm"]), (4, "u3", ["180"]), (5, "nowhere", ["x"]), (6, None, ["x"]), (7, "u4", ["x"])]
    claims = spark.createDataFrame(rows, "claim int, url string, expected array<string>")
    got = {r.claim: (r.ok, r.reason) for r in G.verify(claims, pages(spark)).collect()}
    assert got == {1: (True, "ok"), 2: (False, "missing: absent"), 3: (False, "HTTP 404"), 4: (False, "soft error: just a moment"), 5: (False, "HTTP 000"), 6: (False, "HTTP 000"), 7: (False, "missing: x")}
    assert {r.claim: r.ok for r in G.verify(claims, pages(spark), every=False).collect()}[2]
    assert {r.claim: r.url for r in G.supported_url(G.verify(claims, pages(spark))).collect()}[3] is None


def test_corroborate_and_fills(spark):
    claims = spark.createDataFrame([(1, "u1", "180000"), (2, "u1", "250000000"), (3, "u1", "176400"), (4, "u1", "Knutsen OAS"), (5, "u1", ""), (6, "u2", "180000"), (7, "u1", "Knutsen Absent")], "claim int, url string, value string")
    got = {r.claim: (r.ok, r.reason) for r in G.corroborate(claims, pages(spark)).collect()}
    assert got == {1: (True, "ok"), 2: (True, "ok"), 3: (False, "value not on page"), 4: (True, "ok: all words"), 5: (True, "no value"), 6: (False, "HTTP 404"), 7: (False, "value not on page")}
    fills = spark.createDataFrame([(1, "180000", ["u2", "u1", "u1"], False), (2, "9", ["u1"], False), (3, "9", ["u3"], True), (4, "9", None, None)], "fill int, value string, urls array<string>, derivable boolean")
    assert {r.fill: (r.kept, r.dead, r.conflicts, r.outcome, r.level) for r in G.gate_fills(fills, pages(spark)).collect()} == {1: ("u1", 1, 0, "pass", "partial"), 2: ("", 0, 1, "blank", "none"), 3: ("", 1, 0, "derived", "none"), 4: ("", 0, 0, "blank", "none")}


def test_ref_verdicts_and_dead_links(spark):
    cells = spark.createDataFrame([(1, "180000", "u1, u2\nu9", False), (2, "7", "u1", True), (3, "7777", "u1", False), (4, "1", None, None)], "cell int, value string, ref string, preserve boolean")
    assert {(r.cell, r.url, r.verdict) for r in G.ref_verdicts(cells, pages(spark), ("u2",)).collect()} == {(1, "u1", "PASS"), (1, "u2", "SOFT-KEPT"), (1, "u9", "DROPPED-unreachable"), (2, "u1", "PRESERVED"), (3, "u1", "DROPPED-conflict")}
    sheet = spark.createDataFrame([("http://d, http://e", None), ("http://d\nname", "http://d")], "a string, b string")
    p = spark.createDataFrame([("http://d", "404", ""), ("http://e", "200", "")], "url string, status string, html string")
    assert [tuple(r) for r in G.dead_links(sheet, ["a", "b"], p).collect()] == [("http://d", 3, "HTTP 404")]


COLS = ["owner", "country", "cargo"]


def grid(spark):
    return spark.createDataFrame([(1, "O", None, " membrane "), (2, "P", "JP", "")], "key long, owner string, country string, cargo string")


def test_patches(spark):
    p = spark.createDataFrame([(1, 1, "country", "KR"), (2, 2, "country", "KR"), (3, 2, "country", "JP"), (4, 9, "cargo", "x"), (5, 1, "nope", "x"), (6, None, "cargo", "x"), (7, 1, "country", "CN")], "patch_id int, key long, column_name string, value string")
    status = lambda **k: {r.patch_id: r.status for r in A.apply_set(p, grid(spark), COLS, **k).collect()}
    assert status() == {1: "written", 2: "kept", 3: "same", 4: "no-row", 5: "no-column", 6: "no-row", 7: "written"} and status(overwrite=True)[2] == "written"
    assert {r.key: (r.owner, r.country, r.cargo) for r in A.patched_rows(grid(spark), p, COLS).collect()} == {1: ("O", "CN", "membrane"), 2: ("P", "JP", "")}
    assert {r.key: r.country for r in A.appended_rows(p, COLS).where("key is not null").collect()} == {1: "CN", 2: "JP", 9: ""}
    acc = p.select(F.col("patch_id").alias("cell_id"), "key", "column_name", "value")
    assert {r.cell_id: r.status for r in A.verify_cells(acc, grid(spark), COLS).collect()} == {1: "MISSING", 2: "MISMATCH", 3: "landed", 4: "MISSING", 5: "MISSING", 6: "MISSING", 7: "MISSING"}
    links = spark.createDataFrame([(1, 0, "http://n"), (1, 1, "http://o")], "key long, pos int, url string")
    assert [r.cell for r in A.merged_refs(grid(spark).withColumn("owner", F.lit("http://o")), links, "owner").collect()] == ["http://o, http://n"]


def test_rows_present_and_base_first(spark):
    new = spark.createDataFrame([(1, "A  b", ""), (2, "", "h"), (3, None, None), (4, "zz", "")], "new_id int, name string, hull string")
    sheet = spark.createDataFrame([(7, "A b", "x"), (8, "c", "h"), (9, "A b", "")], "record_id long, name string, hull string")
    assert {r.new_id: (r.present_in, r.present) for r in A.rows_present(new, sheet).collect()} == {1: (7, True), 2: (8, True), 3: (None, True), 4: (None, False)}
    rev = spark.createDataFrame([(1, "R"), (2, " "), (5, "N")], "key long, owner string")
    assert {r.key: (r.owner, r.cargo) for r in A.base_first(grid(spark), rev, COLS).collect()} == {1: ("R", ""), 2: ("P", ""), 5: ("N", "")}


def test_proposals(spark):
    assert P.row_range("9-5") == (5, 9) and P.row_range(" 7 ") == (7, 7)
    with pytest.raises(ValueError):
        P.row_range("x")
    rows = spark.createDataFrame([(0, "c1", {"a": "1"}, "G", None), (1, "c1", {"a": "2"}, "Y", None)], "pos int, cluster_id string, row_data map<string,string>, confidence string, note string")
    assert sorted(r.item_id for r in P.row_items(rows).collect()) == ["cluster:c1", "cluster:c1#2"] and {r.item_id for r in P.row_items(rows, split=False).collect()} == {"cluster:c1"}
    fills = spark.createDataFrame([("1", "cap", "9", "G", None, "n")], "row_id string, field string, proposed_value string, confidence string, derivable boolean, note string")
    cites = spark.createDataFrame([("1", "cap", ["u", "v"], "G", None)], "row_id string, field string, urls array<string>, confidence string, note string")
    both = P.fill_items(fills).unionByName(P.cite_items(cites, {"cap": "Capacity"}))
    assert {(r.item_id, r.value) for r in both.collect()} == {("1|cap", "9"), ("1|Capacity", "u, v")} and both.columns == P.ITEM
    found = spark.createDataFrame([({"row_id": "1", "field": "f", "finding": "why"}, None), (None, "text only"), ({}, "")], "values map<string,string>, text string")
    assert [(r.row_id, r.column_name, r.note, r.decision) for r in P.finding_rows(found).collect()] == [("1", "f", "why", "hold"), ("", "", "text only", "hold"), ("", "", "", "hold")]
    items = spark.createDataFrame([("a", "Accept"), ("b", "hold"), ("c", None)], "item_id string, default_decision string")
    said = spark.createDataFrame([("b", " REJECT "), ("a", ""), ("b", None)], "item_id string, decision string")
    assert {r.item_id: r.effective for r in P.overlay_decisions(items, said).collect()} == {"a": "accept", "b": "reject", "c": ""}


def test_sheet_files(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('﻿1,2\nId,Shipowner,Shipbuilder,,\n7,"A ""x""\nb",Y\n\n8,B\n9,C,D,E,F,G\n', encoding="utf-8")
    got = S.read_sheet(spark, str(path)).orderBy("sheet_row").collect()
    assert got[0].asDict() == {"sheet_row": 3, "Id": "7", "Shipowner": 'A "x"\nb', "Shipbuilder": "Y", "_blank_1": "", "_blank_2": ""}
    assert [(r.sheet_row, r.Id) for r in got] == [(3, "7"), (5, "8"), (6, "9")]
    with pytest.raises(ValueError):
        S.read_sheet(spark, str(path), least_bytes=10_000)
    with pytest.raises(ValueError):
        S.header_row([["a"], ["b"]])
    assert S.column_map(["Status [ref]", "Status", "Name"], {"status": "Status", "owner": "Shipowner", "nm": "nam"}) == {"status": "Status", "owner": None, "nm": "Name"}
    assert S.unique_headers(["a", "", "a", " "]) == ["a", "_blank_1", "a_2", "_blank_2"]


def test_documents(spark, tmp_path):
    (tmp_path / "candidates.json").write_text("{}")
    assert S.batch_mode(str(tmp_path))[0] == "discovery"
    (tmp_path / "data_fill.json").write_text(json.dumps({"fills": [{"row_id": "1", "field": "cap", "new_urls": ["u"], "derivable": True}], "candidate_findings": [{"row_id": "2", "x": "y"}]}))
    mode, path = S.batch_mode(str(tmp_path))
    fills, found = S.read_proposals(spark, path)
    assert mode == "data_fill" and fills.head().new_urls == ["u"] and found.head()["values"]["x"] == "y"
    with pytest.raises(FileNotFoundError):
        S.batch_mode(str(tmp_path / "no"))
    for k in "ab":
        (tmp_path / f"research_{k}.json").write_text(json.dumps({"fills": [{"row_id": "1", "field": "cap", "proposed_value": k}]}))
    got = S.read_research(spark, [str(tmp_path / f"research_{k}.json") for k in "ba"])
    assert [r.proposed_value for r in P.first_wins(got, ["row_id", "field"], ["src", "pos"]).collect()] == ["b"]
    (tmp_path / "fleet.json").write_text(json.dumps({"edition_year": 2026, "vessels": [{"vessel_name": "A", "ex_names": ["B"]}, {"vessel_name": "C"}]}))
    assert [(r.idx, r.vessel_name, r.ex_names) for r in S.read_fleet(spark, str(tmp_path / "fleet.json")).orderBy("idx").collect()] == [(0, "A", ["B"]), (1, "C", None)]
    (tmp_path / "s.colmap.json").write_text('{"a": "b"}')
    assert S.load_colmap(str(tmp_path / "s.csv")) == {"a": "b"}
    grid_ = spark.createDataFrame([(1, "x #REF! #N/A", None)], "k int, a string, b string")
    assert [tuple(r) for r in S.cell_errors(grid_, "k", ["a", "b"]).collect()] == [(1, "a", "#REF!")]


def test_pages(spark):
    row = lambda n, hull, kind, owner, d, c: f'<tr><td>{n}</td> <td><a href="ship.aspx?t{n}">{hull}</a></td><td>{kind}</td><td>{owner}</td><td>{d}</td><td>{c}</td></tr>'
    html = "<table>" + row(1, "H－12", "LNG Tanker 174,000", "A &amp; B", "2028 - 05", "2026 - 02") + row(2, "Yard", "LNG Bunker FSRU", "C", "", "") + "<tr><td>x</td></tr></table>"
    rows = H.order_rows(spark.createDataFrame([("y", html), ("z", None), ("w", "")], "yard string, html string"))
    got = rows.orderBy("row_num").collect()
    assert [(r.row_num, r.hull, r.hull_assigned, r.owner, r.delivery, r.contract, r.ship_token) for r in got] == [(1, "H-12", True, "A & B", "2028-05", "2026-02", "t1"), (2, "Yard", False, "C", "", "", "t2")]
    assert [r.row_num for r in H.order_filter(rows, True, "2026-01").collect()] == [1] and H.more_pages(rows, "2026-01").head().more
    links = spark.createDataFrame([("9123456", '<a href="/x"><a href="/v/9123456"><a href="/v/9123456?b">'), ("1", "")], "number string, html string")
    assert {r.number: r.link for r in H.id_links(links).collect()} == {"9123456": "/v/9123456", "1": None}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x" * 200, ["1", None], {"k": "v"}), ("b", None, None, None)], "label string, v string, l array<string>, m map<string,string>")
    for form in ("csv", "json", "parquet"):
        K.write_report(rows, str(tmp_path / form), form, {"v": 120}, ["label"] if form == "json" else None)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).orderBy("label").collect()
    assert len(back[0].v) == 120 and back[0].l == "1 + ?" and back[0].m == '{"k":"v"}'
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    assert "| b | 2 |" in K.digest(spark.createDataFrame([("b", 2), ("a", 1)], "label string, n long"), "T") and "more than 1 rows" in K.digest(spark.createDataFrame([("b", 2), ("a", 1)], "label string, n long"), "T", 1)
    cells = K.styled_cells(grid(spark), spark.createDataFrame([(1, "country", "KR", "Y")], "key long, column_name string, value string, confidence string"), "key", COLS)
    assert {(r.key, r.column_name): r.fill for r in cells.collect()}[1, "country"] == "yellow"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 5), (2, "a", 65), (1, "b", 6)], "id int, kind string, s long").select("id", "kind", F.timestamp_seconds("s").alias("at")).write.parquet(src)
    stream = I.read_rows(spark, src, spark.read.parquet(src).schema)
    for name, df, mode in (("first", I.first_deliveries(stream, "id", "at"), "append"), ("win", I.counts_by_window(stream, "at", "kind", "1 minute"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("first").count() == 2 and {(r.kind, r.n) for r in spark.table("win").collect()} == {("a", 1), ("b", 1)}
