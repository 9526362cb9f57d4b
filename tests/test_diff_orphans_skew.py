from datetime import datetime

from pyspark.sql import functions as F

from fairlead.operators.diff import diff_copies
from fairlead.operators.orphans import orphan_references, orphan_report, references, whole_number
from fairlead.operators.skew import salted_join, skew_join

T = [datetime(2024, 1, d) for d in range(1, 29)]


def test_diff(spark):
    cols = "check_id long, status string, v string, loaded_at timestamp, field string, _side int"
    a = spark.createDataFrame([(1, "ok", "a  b", T[0], "x", 1), (1, "ok", "a b", T[1], "x", 1), (2, None, "p", T[0], None, None), (3, "ok", "X", T[0], "", 0), (None, "q", "q", T[0], "", 0), (5, "ok", None, T[0], "", 0)], cols)
    b = spark.createDataFrame([(1, "ok", "a\tb ", T[2], "y", 2), (3, "bad", "x", T[0], "", 0), (4, "ok", "n", T[0], "", 0), (5, " ", "", T[0], "", 0)], cols)
    got = {(r.check_id, r.field, r.kind) for r in diff_copies(a, b, "check_id", ["status", "v"], "loaded_at", ("left", "right")).collect()}
    assert got == {(2, "", "only_in_left"), (4, "", "only_in_right"), (3, "status", "differs"), (3, "v", "differs"), (5, "status", "differs")}


def test_diff_of_empty_tables(spark):
    cols = "check_id long, v string, loaded_at timestamp"
    none, one = spark.createDataFrame([], cols), spark.createDataFrame([(1, "v", T[0])], cols)
    assert diff_copies(none, none, "check_id", ["v"], "loaded_at", ("l", "r")).count() == 0
    assert [r.kind for r in diff_copies(none, one, "check_id", ["v"], "loaded_at", ("l", "r")).collect()] == ["only_in_r"]


def test_whole_number(spark):
    said = ["1,582", " 9", "992.0", "0012", "x", "", None, "1.5", "-3"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(said)], "k int, c string")
    assert [r.n for r in rows.orderBy("k").select(whole_number(F.col("c")).alias("n")).collect()] == [1582, 9, 992, 12, None, None, None, None, -3]


def test_orphans(spark):
    parents = spark.createDataFrame([("1", T[5], None), ("2", T[5], T[10]), ("2", T[7], None), ("3", T[20], T[21]), (None, T[0], None)], "row_id string, loaded_at timestamp, deleted_at timestamp")
    rows = [(1, "1", T[6]), (2, "1.0", T[4]), (3, " 2", T[10]), (4, "2", T[9]), (5, "9", T[9]), (6, None, T[9]), (7, "3", T[22]), (8, "3", T[2]), (9, "abc", T[2]), (10, "9", None), (5, "9", T[9])]
    refs = references(spark.createDataFrame(rows, "id long, row_id string, at timestamp"), "t", "id", "at")
    found = orphan_references(refs, parents)
    assert {(r.ref_key, r.period, r.reason) for r in found.collect()} == {(2, "2024-01", "late"), (3, "2024-01", "deleted"), (5, "2024-01", "missing"), (7, "2024-01", "deleted"), (8, "2024-01", "late"), (10, None, "missing")}
    assert found.count() == 6 and {(r.reason, r.refs) for r in orphan_report(found).where("period is not null").collect()} == {("late", 2), ("deleted", 2), ("missing", 1)}


def test_orphans_of_empty_tables(spark):
    parents = spark.createDataFrame([], "row_id string, loaded_at timestamp, deleted_at timestamp")
    refs = references(spark.createDataFrame([(1, "4", T[0])], "id long, row_id string, at timestamp"), "t", "id", "at")
    assert [r.reason for r in orphan_references(refs, parents).collect()] == ["missing"]
    assert orphan_references(refs.limit(0), parents).count() == 0


def test_salted_join_equals_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 200).alias("k"), "id")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(100)] + [(7, "again")], "k long, r string")
    for how in ("inner", "left"):
        a = salted_join(left, right, "k", how, part_rows=100).groupBy("k", "r").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
        b = left.join(right, "k", how).groupBy("k", "r").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_skew_join_without_adaptive_splitting(spark):
    left = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, r string")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert skew_join(left, right, "k").count() == 334 and skew_join(left, right, "k", "left").count() == 500
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert skew_join(left, right, "k").count() == 334 and skew_join(left, right, "k", "left").count() == 500
