"""Duplicates by hard keys and in blocks, and the indexes that such searches use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.parse import digits, digits_int, month_key, ordinals, size_bucket, year
from fairlead.functions.text import strip
from fairlead.operators.lookup import hull_key
from fairlead.operators.skew import skew_join
from fairlead.schema import require

SIZE_GAP, YEAR_GAP = 8_000, 1


def keyed_rows(rows: DataFrame) -> DataFrame:
    """record_id, row_id, builder, owner (tags) with the keys of duplicate search; needs builder_tag and owner_tag columns."""
    need = ["record_id", "row_id", "builder_tag", "owner_tag", "imo_number", "hull_number", "capacity", "delivery_year", "contract_date", "vessel_name", "original_source"]
    rows = require(rows, *need)
    number = digits(F.col("imo_number"))
    return rows.select(
        "record_id", "row_id", F.col("builder_tag").alias("builder"), F.col("owner_tag").alias("owner"), F.when(F.length(number) >= 6, number).otherwise("").alias("imo"),
        hull_key(F.col("hull_number")).alias("hull"), digits_int(F.col("capacity")).alias("size"), size_bucket(F.col("capacity")).alias("bucket"), year(F.col("delivery_year")).alias("year"),
        month_key(F.col("contract_date")).alias("month"), ordinals(strip(F.col("vessel_name")), strip(F.col("hull_number")), strip(F.col("original_source"))).alias("marks"),
    ).withColumn("slot", (F.col("hull") == "") & (F.col("imo") == ""))


def key_index(keyed: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(key, rows, first_record, last_record) of a composite key without blanks. Rows are counted, never gathered."""
    own = keyed
    for c in columns:
        own = own.where(F.col(c) != "")
    return own.groupBy(F.concat_ws("|", *columns).alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.min("record_id").alias("first_record"), F.max("record_id").alias("last_record")).select(F.lit(name).alias("kind"), "key", "rows", "first_record", "last_record")


def index_stats(keyed: DataFrame) -> DataFrame:
    """Rows, distinct hull keys and distinct order keys; approximate distinct counts are not used."""
    full = lambda *cs: F.when(sum(((F.col(c) == "").cast("int") for c in cs), F.lit(0)) == 0, F.concat_ws("|", *cs))
    return keyed.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(full("builder", "hull")).alias("hull_keys"), F.count_distinct(full("builder", "owner", "month")).alias("order_keys"))


def shared_key(keyed: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(kind, key, record_id) of every record whose composite key two or more row ids share: class and members, no pairs."""
    own = keyed
    for c in columns:
        own = own.where(F.col(c) != "")
    own = own.select("record_id", "row_id", F.concat_ws("|", *columns).alias("key"))
    many = own.groupBy("key").agg(F.min("row_id").alias("lo"), F.max("row_id").alias("hi")).where("lo <> hi").select("key")
    return skew_join(own, many, "key").select(F.lit(name).alias("kind"), "key", "record_id")


def _may_match(a: str, b: str):
    """Condition that two rows of a block may be one slot: at least one is a slot, sizes and years near, hard keys not apart."""
    col = lambda s, c: F.col(f"{s}.{c}")
    near_size = F.coalesce(F.abs(col(a, "size") - col(b, "size")) <= SIZE_GAP, F.lit(True))
    far_year = (col(a, "year") != "") & (col(b, "year") != "") & (F.abs(col(a, "year").try_cast("int") - col(b, "year").try_cast("int")) > YEAR_GAP)
    return near_size & ~far_year & (col(a, "slot") | col(b, "slot"))


def _apart(a: str, b: str):
    marks = [F.col(f"{s}.marks") for s in (a, b)]
    return (F.size(marks[0]) > 0) & (F.size(marks[1]) > 0) & ~F.arrays_overlap(*marks)


def block_links(keyed: DataFrame) -> DataFrame:
    """(record_id, tier2_links, tier4_links): with how many rows of its block a row may share a slot; rows without links are left out.

    A block is (builder, owner, size bucket above 0). Its rows are reduced to cells of equal size, year, slot and marks;
    cells are paired, not rows, so the work depends on how many different cells a block has and no link is lost. Tier 4
    links are those whose ordinal marks are apart.
    """
    own = keyed.where("builder <> '' and owner <> '' and bucket > 0").withColumn("block", F.concat_ws("|", "builder", "owner", F.col("bucket").cast("string")))
    cells = own.groupBy("block", "size", "year", "slot", F.array_join("marks", ",").alias("_m")).agg(F.count(F.lit(1)).alias("n"), F.first("marks").alias("marks"))
    own = own.withColumn("_m", F.array_join("marks", ","))
    pairs = cells.alias("a").join(cells.alias("b"), F.col("a.block") == F.col("b.block")).where(_may_match("a", "b"))
    same = (F.col("a.size") == F.col("b.size")) & (F.col("a.year") == F.col("b.year")) & (F.col("a.slot") == F.col("b.slot")) & (F.col("a._m") == F.col("b._m"))
    others = F.col("b.n") - F.when(same, 1).otherwise(0)  # a row is no partner of its own
    per_cell = pairs.groupBy("a.block", "a.size", "a.year", "a.slot", "a._m").agg(F.sum(F.when(~_apart("a", "b"), others).otherwise(0)).alias("tier2_links"), F.sum(F.when(_apart("a", "b"), others).otherwise(0)).alias("tier4_links"))
    linked = own.select("record_id", "block", "size", "year", "slot", "_m").join(per_cell.where("tier2_links + tier4_links > 0"), ["block", "size", "year", "slot", "_m"])
    return linked.select("record_id", "tier2_links", "tier4_links")


def focus_pairs(keyed: DataFrame, focus: DataFrame) -> DataFrame:
    """(record_id_a, record_id_b, tier): the pairs of block_links that involve a row of ``focus`` (record_id), a search set."""
    own = keyed.where("builder <> '' and owner <> '' and bucket > 0").withColumn("block", F.concat_ws("|", "builder", "owner", F.col("bucket").cast("string")))
    asked = own.join(focus.select("record_id").distinct(), "record_id", "left_semi")
    rename = lambda df, s: df.select("block", F.struct("record_id", "size", "year", "slot", "marks").alias(s))
    met = skew_join(rename(own, "b"), rename(asked, "a"), "block").where(_may_match("a", "b") & (F.col("a.record_id") != F.col("b.record_id")))
    tier = F.when(_apart("a", "b"), 4).otherwise(2)
    return met.select(F.least("a.record_id", "b.record_id").alias("record_id_a"), F.greatest("a.record_id", "b.record_id").alias("record_id_b"), tier.alias("tier")).distinct()
