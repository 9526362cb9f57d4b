"""Queries of the llm operators, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.canon import look_alike_pairs
from fairlead.llm.entity import match, matched
from fairlead.llm.leak import find_leaks, leaked
from fairlead.llm.names import attribute
from fairlead.llm.neardup import entry_pairs, near_records
from fairlead.llm.packing import pack_documents
from fairlead.operators.packed import split_packed
from fairlead.schema import table


#: Where the executors find the vocabulary of problem 8, unless spark.fairlead.vocabulary says so.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def p2_matches(spark: SparkSession, sf: str) -> DataFrame:
    fleet = table(spark, sf, "giignl_fsru_fleet")
    left = fleet.select(
        F.col("fleet_id").alias("id"), F.concat(F.array("vessel_name"), F.coalesce("ex_names", F.array().cast("array<string>"))).alias("names"), F.col("storage_m3").cast("double").alias("size"),
        F.col("built_year").alias("year"), F.col("vessel_owner").alias("owner"), F.col("builder").alias("maker"), F.lit(False).alias("hint"),
    )
    rows = table(spark, sf, "apply_rows")
    size, year = F.regexp_replace(F.btrim("capacity"), ",", ""), F.btrim("delivery_year")
    right = rows.select(
        F.col("record_id").alias("id"), F.concat(F.array("vessel_name"), split_packed(F.col("other_names"))).alias("names"), F.when(size.rlike(r"^\d+(\.\d+)?$"), size.cast("double")).alias("size"),
        F.when(year.rlike(r"^\d{4}$"), year.cast("int")).alias("year"), F.col("shipowner").alias("owner"), F.col("shipbuilder").alias("maker"), (F.col("vessel_type") == "FSRU").alias("hint"),
    )
    return match(left, right).select(F.col("left_id"), "right_id", "confidence", "level")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return matched(p2_matches(spark, sf)).select(F.col("left_id").alias("fleet_id"), F.col("right_id").alias("record_id")).distinct()


def p2_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return matched(p2_matches(spark, sf)).select(F.col("left_id").alias("fleet_id"), F.col("right_id").alias("record_id"), F.round("confidence", 4).alias("confidence"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return entry_pairs(table(spark, sf, "apply_rows"))


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near_records(table(spark, sf, "apply_rows")).select(F.col("id").alias("record_id"), F.col("group").alias("group_id"))


def _organisations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "apply_rows")
    place = {"shipowner": "shipowner_country_area", "shipbuilder": "shipbuilder_yard_country_area"}
    said = rows.select("record_id", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text"), F.col(c).alias("country"), F.col(f"{c}_ref").alias("source")) for f, c in place.items()])))
    said = said.withColumnRenamed("record_id", "mention")
    owners, builders = table(spark, sf, "shipowner_facts"), table(spark, sf, "shipbuilder_facts")
    one = lambda df, field, tag: df.select(F.lit(field).alias("field"), F.col(tag).alias("tag"), F.col(place[field]).alias("tag_country"), F.col(f"{place[field]}_ref").alias("tag_source"))
    return said, one(owners, "shipowner", "owner_tag").unionByName(one(builders, "shipbuilder", "builder_tag"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    said, listed = _organisations(spark, sf)
    exact = listed.select("field", F.col("tag").alias("_tag"))
    variants = said.join(exact, (said.field == exact.field) & (F.lower("text") == F.col("_tag")), "left_anti")
    # All mentions count towards the frequencies; only variants are reported.
    found = attribute(said, listed).join(variants.select(F.col("mention"), "field"), ["mention", "field"], "left_semi")
    return found.select(F.col("mention").alias("record_id"), "field", "tag")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), table(spark, sf, "pack_sizes"), spark.conf.get("spark.fairlead.vocabulary", VOCABULARY))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Of each capacity the pieces, containers and tokens, and the containers that hold too much or a piece twice: none."""
    packed = p8_containers(spark, sf)
    per = packed.groupBy("pack_id", "container").agg(F.sum("tokens").alias("held"), F.count(F.lit(1)).alias("pieces"), F.count_distinct("doc_id", "piece").alias("distinct"))
    sizes = table(spark, sf, "pack_sizes").select("pack_id", "capacity_tokens").distinct()
    out = per.join(sizes, "pack_id").groupBy("pack_id").agg(F.sum("pieces").alias("pieces"), F.count(F.lit(1)).alias("containers"), F.sum("held").alias("tokens"), F.max(F.col("held") > F.col("capacity_tokens")).alias("over"), F.max(F.col("pieces") > F.col("distinct")).alias("twice"))
    return out


def p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaked(p9_leaks(spark, sf))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return look_alike_pairs(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_confidence, p5_found, p5_groups, p6_found, p8_containers, p8_fill, p9_found, p9_leaks, p10_found)}
ORACLES: dict[str, str] = {}
