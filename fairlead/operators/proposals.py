"""Proposed cell values: brought to one shape, merged, overlaid with decisions, and derived where the table itself gives them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.parse import cell_state, date_int
from fairlead.functions.text import split_refs, strip
from fairlead.operators.lookup import usable
from fairlead.operators.skew import skew_join

ITEM = ["item_id", "kind", "row_id", "cluster_id", "column_name", "value", "confidence", "derivable", "note"]
# The keys under which free-form findings hold the same thing, best first.
FINDING_KEYS = {
    "row_id": ["row_id", "row"],
    "column_name": ["column", "field"],
    "existing": ["existing_value", "existing", "current"],
    "proposed": ["proposed_value", "proposed", "value"],
    "note": ["recommendation", "finding", "note", "reason", "action", "url"],
}


def row_range(spec: str) -> tuple[int, int]:
    """'5', '5-9' or '9-5' as (least, most)."""
    m = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", spec)
    if not m:
        raise ValueError(f"no row range: {spec!r}")
    a, b = int(m[1]), int(m[2] or m[1])
    return min(a, b), max(a, b)


def in_rows(row_id: Column, least: int, most: int) -> Column:
    """Whether a row id consists of digits and lies in the range."""
    s = strip(row_id)
    return F.coalesce(s.rlike(r"^\d{1,18}$") & s.try_cast("bigint").between(least, most), F.lit(False))


def updated_since(c: Column, cut: int) -> Column:
    """Whether a typed date (see date_int) is at or after ``cut``; unreadable ones count as 0."""
    return F.coalesce(date_int(c), F.lit(0)) >= cut


def fill_items(fills: DataFrame) -> DataFrame:
    """Items of proposed fills (row_id, field, proposed_value, confidence, derivable, note)."""
    key = F.concat_ws("|", "row_id", "field")
    return fills.select(key.alias("item_id"), F.lit("fill").alias("kind"), "row_id", F.lit(None).cast("string").alias("cluster_id"), F.col("field").alias("column_name"), F.col("proposed_value").alias("value"), "confidence", F.coalesce("derivable", F.lit(False)).alias("derivable"), "note")


def row_items(candidates: DataFrame, split: bool = True) -> DataFrame:
    """Items of whole new rows (pos, cluster_id, row_data map, confidence, note).

    Rows of one cluster would share the id 'cluster:<id>'; unless ``split`` is off they get '#n' after it, so that a
    decision on one is none on its sisters.
    """
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("cluster_id").orderBy("pos"))
    item = F.concat(F.lit("cluster:"), "cluster_id")
    if split:
        item = F.concat(item, F.when(n > 1, F.concat(F.lit("#"), n.cast("string"))).otherwise(""))
    return candidates.select(item.alias("item_id"), F.lit("row").alias("kind"), F.lit(None).cast("string").alias("row_id"), "cluster_id", F.lit(None).cast("string").alias("column_name"), F.to_json("row_data").alias("value"), "confidence", F.lit(False).alias("derivable"), "note")


def cite_items(cites: DataFrame, names: dict[str, str]) -> DataFrame:
    """Items of citations (row_id, field, urls, confidence, note); canonical fields become column names, several links one cell."""
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("field")], F.col("field")) if names else F.col("field")
    return cites.select(F.concat_ws("|", "row_id", name).alias("item_id"), F.lit("cite").alias("kind"), "row_id", F.lit(None).cast("string").alias("cluster_id"), name.alias("column_name"), F.array_join("urls", ", ").alias("value"), "confidence", F.lit(False).alias("derivable"), "note")


def first_given(values: Column, keys: list[str]) -> Column:
    """The first non-blank entry of a string map among ``keys``; ''."""
    got = [strip(values[k]) for k in keys]
    return F.coalesce(*[F.when(g != "", g) for g in got], F.lit(""))


def finding_rows(findings: DataFrame) -> DataFrame:
    """Free-form findings (values map<string,string>, or text string) in one shape, all on hold."""
    text = F.coalesce(strip(F.col("text")), F.lit(""))
    cols = {n: first_given(F.col("values"), ks) for n, ks in FINDING_KEYS.items()}
    cols["note"] = F.when(text != "", text).otherwise(cols["note"])
    return findings.select(*[c.alias(n) for n, c in cols.items()], F.lit("hold").alias("decision"))


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_m"))
    return best.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in [*order, *rest]])


def overlay_decisions(items: DataFrame, decided: DataFrame) -> DataFrame:
    """items (item_id, default_decision, ...) with effective: the human decision where one is given, else the default."""
    human = decided.select("item_id", F.lower(strip(F.col("decision"))).alias("_d")).where("_d <> ''").groupBy("item_id").agg(F.max("_d").alias("_d"))
    return items.join(human, "item_id", "left").withColumn("effective", F.coalesce("_d", F.lower(strip(F.col("default_decision"))))).drop("_d")


def sole_source_cells(sheet: DataFrame, pairs: dict[str, str], source: str) -> DataFrame:
    """(record_id, column_name, value): cells with a real value whose only reference is ``source``."""
    made = [F.when((cell_state(F.col(v)) == "value") & (F.concat_ws("\n", split_refs(F.col(r))) == source), F.struct(F.lit(v).alias("column_name"), strip(F.col(v)).alias("value"))) for v, r in pairs.items()]
    return sheet.select("record_id", F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))


def gaps(sheet: DataFrame, columns: list[str]) -> DataFrame:
    """(record_id, row_id, column_name, state) of the cells that are blank or unknown."""
    made = [F.when(cell_state(F.col(c)) != "value", F.struct(F.lit(c).alias("column_name"), cell_state(F.col(c)).alias("state"))) for c in columns]
    return sheet.select("record_id", "row_id", F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))


def derivable_fills(sheet: DataFrame, tag: str, facts: DataFrame, columns: list[str]) -> DataFrame:
    """(record_id, column_name, value): usable facts (tag, columns) for blank cells of rows with that tag. 'unknown' and blank tags derive nothing."""
    known = facts.select(F.col("tag").alias("_t"), *[usable(F.col(c)).alias(f"_f_{c}") for c in columns])
    own = sheet.select("record_id", F.col(tag).alias("_t"), *[strip(F.col(c)).alias(c) for c in columns]).where("_t <> '' and _t <> 'unknown'")
    made = [F.when((F.col(c) == "") & F.col(f"_f_{c}").isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(f"_f_{c}").alias("value"))) for c in columns]
    return skew_join(own, known, "_t").select("record_id", F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))


def gap_targets(found: DataFrame, sheet: DataFrame, cluster: list[str]) -> DataFrame:
    """Per cluster: its rows with gaps and its gaps, as counts."""
    return found.join(sheet.select("record_id", *cluster), "record_id").groupBy(*cluster).agg(F.count_distinct("record_id").alias("rows"), F.count(F.lit(1)).alias("cells"))
