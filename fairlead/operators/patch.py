"""Patches of cells by row key and column name: applied, appended, verified. The sheet itself is never changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.text import squash, strip
from fairlead.operators.skew import skew_join


def cell_of(columns: list[str], name: Column) -> Column:
    """The stripped cell of the column that ``name`` says; null if there is no such column."""
    return F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[strip(F.col(c)) for c in columns]))[name]


def verify_cells(accepted: DataFrame, sheet: DataFrame, columns: list[str], key: str = "key") -> DataFrame:
    """accepted (cell_id, key, column_name, value) with found and status: landed, MISMATCH or MISSING (blank, or no such row).

    sheet has one row per key. Wide rows are met once, by key; no sheet is unpivoted. White space is normalised.
    """
    own = accepted.select("cell_id", key, "column_name", squash(F.col("value")).alias("value"))
    got = skew_join(own, sheet.select(key, *columns), key, "left")
    found = squash(F.coalesce(cell_of(columns, F.col("column_name")), F.lit("")))
    status = F.when(F.col("found") == "", "MISSING").when(F.col("found") == F.col("value"), "landed").otherwise("MISMATCH")
    return got.select("cell_id", "column_name", "value", found.alias("found")).withColumn("status", status)


def rows_present(new: DataFrame, sheet: DataFrame) -> DataFrame:
    """new (new_id, name, hull) with present_in, the least record_id whose name or hull is equal; rows with neither count as present without one."""
    keys = lambda df, i: df.select(i, F.explode(F.array(F.struct(F.lit("n").alias("k"), squash(F.col("name")).alias("v")), F.struct(F.lit("h").alias("k"), squash(F.col("hull")).alias("v")))).alias("x")).select(i, "x.k", "x.v").where("v <> ''").withColumn("kv", F.concat_ws(":", "k", "v")).select(i, "kv")
    own = keys(sheet, "record_id").groupBy("kv").agg(F.min("record_id").alias("record_id"))
    hit = skew_join(keys(new, "new_id"), own, "kv").groupBy("new_id").agg(F.min("record_id").alias("present_in"))
    bare = (squash(F.col("name")) == "") & (squash(F.col("hull")) == "")
    return new.select("new_id", bare.alias("unverifiable")).join(hit, "new_id", "left").select("new_id", "present_in", (F.col("present_in").isNotNull() | F.col("unverifiable")).alias("present"))


def apply_set(patch: DataFrame, sheet: DataFrame, columns: list[str], key: str = "key", overwrite: bool = False) -> DataFrame:
    """patch (patch_id, key, column_name, value) with what applying it does: written, same, no-column, no-row or kept (another value is there)."""
    have = sheet.select(key, F.lit(True).alias("_row"), *columns)
    got = skew_join(patch.select("patch_id", key, "column_name", strip(F.col("value")).alias("value")), have, key, "left")
    cell = cell_of(columns, F.col("column_name"))
    status = (
        F.when(F.col("_row").isNull(), "no-row").when(~F.col("column_name").isin(columns), "no-column").when(F.col("old") == F.col("value"), "same")
        .when((F.col("old") != "") & F.lit(not overwrite), "kept").otherwise("written")
    )
    return got.select("patch_id", key, "column_name", "value", "_row", cell.alias("old")).withColumn("status", status).drop("_row")


def patched_rows(sheet: DataFrame, patch: DataFrame, columns: list[str], key: str = "key", order: str = "patch_id") -> DataFrame:
    """The rows that a patch touches, full width, after it: of several values for a cell the last by ``order`` stays."""
    last = patch.where(F.col("column_name").isin(columns)).groupBy(key, "column_name").agg(F.max_by("value", order).alias("value"))
    cells = last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("column_name", "value"))).alias("_p"))  # at most a row's width
    got = sheet.join(cells, key)
    return got.select(key, *[F.coalesce(F.col("_p")[c], strip(F.col(c))).alias(c) for c in columns])


def merged_refs(sheet: DataFrame, links: DataFrame, ref: str, key: str = "key") -> DataFrame:
    """(key, cell): a reference cell with all new links of its row appended once, in order (links: key, pos, url)."""
    new = links.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("_n"))
    from fairlead.functions.text import join_refs

    return sheet.select(key, F.col(ref)).join(new, key).select(key, join_refs(F.col(ref), F.transform("_n", lambda x: x["url"])).alias("cell"))


def appended_rows(patch: DataFrame, columns: list[str], key: str = "key", order: str = "patch_id") -> DataFrame:
    """Append patches (key, column_name, value) as one row per key in column order; the last value of a cell stays."""
    pivot = patch.where(F.col("column_name").isin(columns)).groupBy(key).pivot("column_name", columns).agg(F.max_by("value", order))
    return pivot.select(key, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def base_first(live: DataFrame, reviewed: DataFrame, columns: list[str], key: str = "key") -> DataFrame:
    """Live rows, each replaced by the reviewed row of its key if there is one with any cell; reviewed rows without a live one are added."""
    some = F.lit(False)
    for c in columns:
        if c in reviewed.columns:
            some = some | (strip(F.col(c)) != "")
    good = reviewed.where(some & (strip(F.col(key)) != ""))
    base = good.select(key, *[(F.col(c) if c in good.columns else F.lit("")).alias(c) for c in columns])
    return base.unionByName(live.select(key, *columns).join(base.select(key), key, "left_anti"))
