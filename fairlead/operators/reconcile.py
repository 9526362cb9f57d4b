"""Reconciliation of a roster with the sheet by names, and of two tables by a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.functions.text import strip, vessel_key
from fairlead.operators.skew import skew_join
from fairlead.session import settle

# Tolerance of sizes, absolute and relative, and the size below which a thing is small.
SIZE_TOLERANCE, SIZE_SHARE, SMALL_SIZE = 6_000, 0.03, 60_000


def size_agrees(a: Column, b: Column) -> Column:
    """Whether two sizes agree within the tolerance; null if either is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) <= F.greatest(F.lit(float(SIZE_TOLERANCE)), SIZE_SHARE * F.greatest(a, b)))


def size_distance(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a - b).cast("double"), F.lit(float("inf")))


def name_keys(df: DataFrame, key: str, current: str, former: str | None) -> DataFrame:
    """(key, name_key) of all names of a record, normalised, blank ones gone."""
    names = F.array(F.col(current)) if former is None else F.concat(F.array(F.col(current)), F.coalesce(F.col(former), F.array().cast("array<string>")))
    return df.select(F.col(key), F.explode(F.array_distinct(F.transform(names, vessel_key))).alias("name_key")).where("name_key <> ''")


def name_join(roster: DataFrame, sheet: DataFrame, kind: str = "FSRU") -> DataFrame:
    """The best sheet record for each roster record that shares a name with one.

    roster: idx (file order), vessel_name, ex_names, size; sheet: pos (row order), name, size, vessel_type. Records of
    ``kind`` are preferred, then the nearest size, then the first row. Names are exploded to keys and equi-joined, never
    compared with OR. Returns idx, pos, vessel_type, distance.
    """
    keys = name_keys(roster, "idx", "vessel_name", "ex_names").join(roster.select("idx", F.col("size").alias("_s")), "idx")
    own = sheet.select("pos", vessel_key(F.col("name")).alias("name_key"), F.col("size").alias("_b"), "vessel_type").where("name_key <> ''")
    hits = skew_join(own, keys, "name_key").select("idx", "pos", F.coalesce("vessel_type", F.lit("")).alias("vessel_type"), size_distance(F.col("_s"), F.col("_b")).alias("distance"))
    rank = F.struct((F.col("vessel_type") != kind).alias("other"), "distance", "pos", "vessel_type")
    return hits.groupBy("idx").agg(F.min(rank).alias("m")).select("idx", F.col("m.pos").alias("pos"), F.col("m.vessel_type").alias("vessel_type"), F.col("m.distance").alias("distance"))


def suggest(roster: DataFrame, sheet: DataFrame, named: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """(idx, pos): for roster records without a shared name the sheet record of agreeing size and a common owner tag.

    roster: idx, size, year, tags; sheet: pos, size, year, tags (arrays of owner tags). Roster records choose in file
    order: nearest year (unknown: 999), then size, then row; a row taken by a name match of an earlier roster record or
    by an earlier choice is gone. Rows alike in tags, size, year and the time they are gone form a cell and are taken in
    row order, so a cell offers a record the row after those that earlier records choose there. In every round each
    record takes its best offer, given the choices of the round before; the earliest record that is not yet right becomes
    so, hence choices that no longer change are the sequential ones. Of a cell only as many first rows are read as
    there are records that ask it. Rounds end when nothing changes, or fail after ``most_rounds`` if given.
    """
    used = named.groupBy("pos").agg(F.min("idx").alias("gone"))
    rows = sheet.select("pos", "size", "year", F.array_join(F.array_sort("tags"), "|").alias("t"), "tags").where("size is not null and size(tags) > 0")
    rows = settle(rows.join(used, "pos", "left").withColumn("gone", F.coalesce("gone", F.lit(1 << 60))).withColumn("cell", F.struct("t", "size", "year", "gone")))
    cells = rows.groupBy("cell").agg(F.first("tags").alias("tags")).select("cell", "cell.size", "cell.year", "cell.gone", "tags")
    askers = roster.join(named.select("idx"), "idx", "left_anti").select("idx", F.col("size").alias("s"), F.col("year").alias("y"), F.explode("tags").alias("tag")).where("s is not null")
    met = skew_join(cells.select("cell", "size", "year", "gone", F.explode("tags").alias("tag")), askers, "tag").where(size_agrees(F.col("s"), F.col("size")) & (F.col("gone") > F.col("idx")))
    gap = F.when((F.coalesce("y", F.lit(0)) != 0) & (F.coalesce("year", F.lit(0)) != 0), F.abs(F.col("y") - F.col("year"))).otherwise(999)
    asked = settle(met.select("idx", F.to_json("cell").alias("cell"), gap.alias("gap"), F.abs(F.col("s") - F.col("size")).alias("far")).distinct())
    need = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("need"))
    spots = rows.select("pos", F.to_json("cell").alias("cell")).join(need, "cell")
    # Only as many first rows of a cell as there are records that ask it are ever taken.
    firsts = settle(spots.withColumn("k", F.row_number().over(W.partitionBy("cell").orderBy("pos"))).where("k <= need").select("cell", "pos", "k"))
    earlier = F.coalesce(F.sum("_mine").over(W.partitionBy("cell").orderBy("idx").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # askers of one cell: a part of the roster, never of the sheet
    chosen = asked.select("idx", "cell").limit(0).withColumn("pos", F.lit(None).cast("long"))
    rounds = 0
    while most_rounds is None or rounds < most_rounds:
        rounds += 1
        told = asked.join(chosen.select("idx", "cell", F.lit(1).alias("_mine")), ["idx", "cell"], "left").withColumn("_mine", F.coalesce("_mine", F.lit(0)))
        offers = told.withColumn("k", (earlier + 1).cast("int")).join(firsts, ["cell", "k"])
        new = settle(offers.groupBy("idx").agg(F.min(F.struct("gap", "far", "pos", "cell")).alias("m")).select("idx", F.col("m.cell").alias("cell"), F.col("m.pos").alias("pos")))
        if new.exceptAll(chosen.select(*new.columns)).isEmpty() and chosen.select(*new.columns).exceptAll(new).isEmpty():
            return new.select("idx", "pos")
        chosen = new
    raise RuntimeError("suggestions did not settle")


def buckets(roster: DataFrame, sheet: DataFrame, kind: str = "FSRU") -> DataFrame:
    """(bucket, idx, pos, small): every roster record as matched, reclassify, manual or candidate, every unused sheet record of ``kind`` as sheet_only.

    roster: idx, vessel_name, ex_names, size, year, tags, grade; sheet: pos, name, size, year, tags, vessel_type. small
    marks candidates below SMALL_SIZE (unknown counts as 0) or of grade 'other'.
    """
    named = settle(name_join(roster, sheet, kind))
    manual = settle(suggest(roster, sheet, named))
    found = named.select(F.when(F.col("vessel_type") == kind, "matched").otherwise("reclassify").alias("bucket"), "idx", "pos").unionByName(manual.select(F.lit("manual").alias("bucket"), "idx", "pos"))
    small = (F.coalesce("size", F.lit(0)) < SMALL_SIZE) | (F.lower(strip(F.col("grade"))) == "other")
    rest = roster.join(found.select("idx"), "idx", "left_anti").select(F.lit("candidate").alias("bucket"), "idx", F.lit(None).cast("bigint").alias("pos"), small.alias("small"))
    only = sheet.where(F.col("vessel_type") == kind).join(found.select("pos"), "pos", "left_anti").select(F.lit("sheet_only").alias("bucket"), F.lit(None).cast("bigint").alias("idx"), "pos", F.lit(None).cast("boolean").alias("small"))
    return found.withColumn("small", F.lit(None).cast("boolean")).unionByName(rest).unionByName(only)


def pair_differences(pairs: DataFrame) -> DataFrame:
    """Three-valued agreement of matched pairs: size_agrees, year_same, owner_overlap, builder_same; null if a side is unknown.

    pairs: idx, pos, l_size, r_size, l_year, r_year, l_tags, r_tags, l_builder, r_builder.
    """
    both = lambda a, b, test: F.when(a & b, test)
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    known = lambda c: F.coalesce(F.col(c), F.lit(0)) != 0
    return pairs.select(
        "idx", "pos", size_agrees(F.col("l_size"), F.col("r_size")).alias("size_agrees"), both(known("l_year"), known("r_year"), F.col("l_year") == F.col("r_year")).alias("year_same"),
        both(some("l_tags"), some("r_tags"), F.arrays_overlap("l_tags", "r_tags")).alias("owner_overlap"), both(given("l_builder"), given("r_builder"), F.col("l_builder") == F.col("r_builder")).alias("builder_same"),
    )


def key_buckets(left: DataFrame, right: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """(bucket, side, key, rows): matched, only_left, only_left_excluded, only_right, contradiction (matched but excluded), null_key.

    Keys are text and compared stripped; each side is first reduced to its distinct keys with counts, so a key that
    holds a third of the rows is one row when the sides meet.
    """
    def keys(df: DataFrame, n: str) -> DataFrame:
        return df.select(strip(F.col(key)).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias(n))

    l, r = keys(left, "l"), keys(right, "r")
    x = keys(excluded, "x").where("key <> ''").select("key", F.lit(True).alias("x"))
    both = l.where("key <> ''").join(r.where("key <> ''"), "key", "full").join(x, "key", "left")
    out = F.coalesce("x", F.lit(False))
    name = (
        F.when(F.col("l").isNotNull() & F.col("r").isNotNull() & out, "contradiction").when(F.col("l").isNotNull() & F.col("r").isNotNull(), "matched")
        .when(F.col("l").isNotNull() & out, "only_left_excluded").when(F.col("l").isNotNull(), "only_left").otherwise("only_right")
    )
    done = both.select(name.alias("bucket"), F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), "both").when(F.col("l").isNotNull(), "left").otherwise("right").alias("side"), "key", (F.coalesce("l", F.lit(0)) + F.coalesce("r", F.lit(0))).alias("rows"))
    nulls = [df.where("key = ''").select(F.lit("null_key").alias("bucket"), F.lit(side).alias("side"), "key", F.col(n).alias("rows")) for df, n, side in ((l, "l", "left"), (r, "r", "right"))]
    return done.unionByName(nulls[0]).unionByName(nulls[1])


def field_differences(pairs: DataFrame, key: str, left: list[str], right: list[str], names: list[str]) -> DataFrame:
    """(key, n, differences): 'name: a | b' for every field whose stripped text differs, in order, joined by '; '; most first is up to the caller."""
    items = []
    for a, b, n in zip(left, right, names, strict=True):
        x, y = strip(F.col(a)), strip(F.col(b))
        items.append(F.when(x != y, F.concat(F.lit(f"{n}: "), x, F.lit(" | "), y)))
    found = F.filter(F.array(*items), lambda v: v.isNotNull())
    return pairs.select(key, F.size(found).alias("n"), F.array_join(found, "; ").alias("differences")).where("n > 0")
