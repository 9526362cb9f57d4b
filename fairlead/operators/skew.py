"""Equi-joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are looked for one by one; any other key holds less than 1/MOST_HOT of the rows.
MOST_HOT = 1_000


def spread_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """left joined with right by sorting both, so that no side goes through the driver.

    Spark broadcasts what it estimates to be small, and it estimates exploded rows, what Python made and few columns of
    a compressed file at a hundredth of their size. For sides that grow with the tables.
    """
    return left.join(right.hint("merge"), key, how)


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", spread: bool = False) -> DataFrame:
    """left joined with right, whose rows are few per key: one row or so of ``right`` for each of left.

    Each side is in the plan once. Adaptive execution broadcasts right if it turns out small, and otherwise splits the
    partition of a hot key into as many tasks as its bytes ask for, null keys of a left join included. Where a session
    has that switched off, salted_join() does the same with salts. Don't group by ``key`` right after: a partitioning
    that is needed again is not split. ``spread``: as spread_join().
    """
    conf = left.sparkSession.conf
    if all(str(conf.get(f"spark.sql.adaptive.{k}", "true")).lower() == "true" for k in ("enabled", "skewJoin.enabled")):
        return spread_join(left, right, key, how) if spread else left.join(right, key, how)
    return salted_join(left, right, key, how, spread=spread)


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", part_rows: int = 50_000, spread: bool = False) -> DataFrame:
    """left joined with right where every row of a hot key meets many of right's, so that bytes don't tell the work.

    A key is hot if more than ``part_rows`` rows of left have it. The hot ones are counted beforehand, in one job that
    reads the key column only and combines before its shuffle; the MOST_HOT most frequent are kept, a bounded list that
    is broadcast. A hot key is spread over one part for each ``part_rows`` rows by a hash of the whole row, which a
    task that runs again finds the same, and right repeats its rows for these keys, once for each part. Pass a settled
    ``left``: counting must not compute it again. Null keys match nothing; for how='left' they stay, spread as well.
    ``spread``: as spread_join().
    """
    join = spread_join if spread else DataFrame.join
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows)
    hot = counts.orderBy(F.desc("_n"), key).limit(MOST_HOT).select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts"))
    held = hot.collect()
    if not held:
        return join(left, right, key, how)
    hot = F.broadcast(left.sparkSession.createDataFrame(held, hot.schema))
    whole = [f"`{n}`" for n, kind in left.dtypes if "map<" not in kind and kind != "variant"]
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*whole), F.col("_parts")).cast("int")).otherwise(F.lit(0))
    a = left.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn("_salt", salt).drop("_hot", "_parts")
    every = F.when(F.col("_parts").isNotNull(), F.sequence(F.lit(0), F.col("_parts") - 1)).otherwise(F.array(F.lit(0)))
    b = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(every)).drop("_hot", "_parts")
    return join(a, b, [key, "_salt"], how).drop("_salt")
