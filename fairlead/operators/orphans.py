"""References to records that do not exist, are deleted already or come later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.operators.skew import skew_join
from fairlead.schema import require


def whole_number(c: Column) -> Column:
    """The whole number that a typed id stands for ('1,582', ' 9', '992.0', '0012'); null if it stands for none."""
    bare = F.regexp_replace(F.regexp_replace(c.cast("string"), r"[\s, ]", ""), r"\.0*$", "")
    return F.when(bare.rlike(r"^[+-]?\d{1,18}$"), bare.cast("bigint"))


def references(df: DataFrame, name: str, ref_key: str, at: str, fk: str = "row_id") -> DataFrame:
    """(ref_table, ref_key, key, at) of one table; rows whose foreign key is null or no number refer to nothing."""
    df = require(df, ref_key, at, fk)
    return df.select(F.lit(name).alias("ref_table"), F.col(ref_key).alias("ref_key"), whole_number(F.col(fk)).alias("key"), F.col(at).alias("at")).where(F.col("key").isNotNull())


def orphan_references(refs: DataFrame, parents: DataFrame, key: str = "row_id", loaded: str = "loaded_at", deleted: str = "deleted_at") -> DataFrame:
    """(ref_table, ref_key, period, reason): references of ``refs`` (see references) to parents that fail them.

    missing: no parent has the key. deleted: a parent's deletion is at or before the reference. late: the parent's
    earliest load is after the reference; a reference may be both. A null time of the reference makes it neither, and
    its period null. Distinct foreign keys are anti-joined with the keys of parents, and what is known of each key is
    joined back to the references; keys with a large share of the references are salted.
    """
    own = require(parents, key, loaded, deleted).select(whole_number(F.col(key)).alias("key"), F.col(loaded).alias("_l"), F.col(deleted).alias("_d")).where(F.col("key").isNotNull())
    state = own.groupBy("key").agg(F.min("_l").alias("_loaded"), F.min("_d").alias("_deleted"))
    keys = refs.select("key").distinct()
    missing = keys.join(state, "key", "left_anti").select("key", F.lit(True).alias("_missing"), F.lit(None).cast("timestamp").alias("_loaded"), F.lit(None).cast("timestamp").alias("_deleted"))
    known = keys.join(state, "key").select("key", F.lit(False).alias("_missing"), F.col("_loaded").cast("timestamp"), F.col("_deleted").cast("timestamp"))
    reasons = F.array(
        F.when(F.col("_missing"), F.lit("missing")),
        F.when(F.col("_deleted") <= F.col("at").cast("timestamp"), F.lit("deleted")),
        F.when(F.col("_loaded") > F.col("at").cast("timestamp"), F.lit("late")),
    )
    back = skew_join(refs, missing.unionByName(known), "key")
    return back.select("ref_table", "ref_key", F.date_format("at", "yyyy-MM").alias("period"), F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason")).distinct()


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts per table, period and reason."""
    return found.groupBy("ref_table", "period", "reason").agg(F.count(F.lit(1)).alias("refs"))
