"""Queries of the general training-data operators: p1, p3, p4 and p7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.operators.diff import diff_copies
from fairlead.operators.orphans import orphan_references, orphan_report, references
from fairlead.operators.packed import explode_packed
from fairlead.schema import table
from fairlead.sources.raw_records import checked, rejects, sound_rows

REPORT_FIELDS = ["status", "accepted_value", "backend_value"]


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return checked(table(spark, sf, "apply_rows_raw").select("raw_id", "raw_line"), table(spark, sf, "vocab"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return rejects(_parsed(spark, sf), "raw_id").select("raw_id", "reason").distinct()


def p1_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rejects(_parsed(spark, sf), "raw_id")


def p1_loaded(spark: SparkSession, sf: str) -> DataFrame:
    rows = sound_rows(_parsed(spark, sf), "raw_id")
    return rows.select("raw_id", "row_id", "vessel_name", "yard_location_longitude", "capacity", "operator_charterer", "capacity_number", "longitude_degrees")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    found = diff_copies(table(spark, sf, "verify_report"), table(spark, sf, "verify_rerun"), "check_id", REPORT_FIELDS, "loaded_at", ("report", "rerun"))
    return found.select("check_id", "field", "kind")


def p3_summary(spark: SparkSession, sf: str) -> DataFrame:
    return p3_found(spark, sf).groupBy("kind", "field").agg(F.count(F.lit(1)).alias("checks"))


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    t = lambda n: table(spark, sf, n)
    refs = references(t("decisions"), "decisions", "decision_id", "decided_at")
    refs = refs.unionByName(references(t("apply_accepted"), "apply_accepted", "cell_id", "accepted_at"))
    refs = refs.unionByName(references(t("verify_report"), "verify_report", "check_id", "checked_at"))
    return orphan_references(refs, t("apply_rows"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _orphans(spark, sf)


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_report(_orphans(spark, sf))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "apply_rows").select("record_id", "vessel_name_ref", "other_names")
    return explode_packed(rows, "record_id", {"vessel_name_ref": True, "other_names": False}).distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_rejects, p1_loaded, p3_found, p3_summary, p4_found, p4_report, p7_found)}

_FIELD = r'("(?:[^"]|"")*"|[^",]*)'
RAW_VALUES = rf"""
WITH lines AS (SELECT raw_id, coalesce(raw_line, '') AS raw_line FROM apply_rows_raw),
split AS (
  SELECT raw_id, regexp_full_match(raw_line || ',', '(?s)({_FIELD},)+') AS ok,
         regexp_extract_all(raw_line || ',', '(?s){_FIELD},', 1) AS f FROM lines),
vals AS (
  SELECT raw_id, ok, len(f) AS n,
    [CASE WHEN x[1] = '"' THEN replace(x[2:len(x) - 1], '""', '"') ELSE x END FOR x IN f] AS f FROM split)"""
_P1 = RAW_VALUES + r""",
picked AS (
  SELECT raw_id, ok, n, regexp_replace(f[28], '^\s+|\s+$', '', 'g') AS cap, regexp_replace(f[24], '^\s+|\s+$', '', 'g') AS lon,
         regexp_replace(f[40], '^\s+|\s+$', '', 'g') AS op FROM vals),
reasons AS (
  SELECT *, CASE
    WHEN NOT ok THEN ['broken_quoting'] WHEN n <> 46 THEN ['column_count'] ELSE [
    CASE WHEN cap <> '' AND lower(cap) <> 'unknown' AND NOT (regexp_full_match(cap, '(\d+|\d{1,3}(,\d{3})+)(\.\d+)?')
      AND coalesce(try_cast(replace(cap, ',', '') AS DOUBLE), 0) > 0) THEN 'bad_capacity' END,
    CASE WHEN lon <> '' AND lower(lon) <> 'unknown' AND NOT (regexp_full_match(lon, '[+-]?(\d+(\.\d+)?|\.\d+)')
      AND coalesce(try_cast(lon AS DOUBLE) BETWEEN -180 AND 180, false)) THEN 'bad_longitude' END,
    CASE WHEN op <> '' AND lower(op) <> 'unknown' AND (regexp_matches(op, '(?i)https?://')
      OR lower(op) IN (SELECT lower(term) FROM vocab) OR NOT regexp_matches(op, '\pL')) THEN 'bad_operator' END] END AS r FROM picked)
"""
def _norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '[ \\t\\r\\n]+', ' ', 'g'))"


_PICK = "SELECT check_id, " + ", ".join(f"arg_max({_norm(f)}, loaded_at) AS {f}" for f in REPORT_FIELDS)
_P3_FOUND = (
    f"WITH a AS ({_PICK} FROM verify_report WHERE check_id IS NOT NULL GROUP BY check_id), b AS ({_PICK} FROM verify_rerun WHERE check_id IS NOT NULL GROUP BY check_id), found AS ("
    "SELECT check_id, '' AS field, 'only_in_report' AS kind FROM a WHERE check_id NOT IN (SELECT check_id FROM b)"
    " UNION ALL SELECT check_id, '', 'only_in_rerun' FROM b WHERE check_id NOT IN (SELECT check_id FROM a)"
    + "".join(f" UNION ALL SELECT a.check_id, '{f}', 'differs' FROM a JOIN b USING (check_id) WHERE a.{f} <> b.{f}" for f in REPORT_FIELDS)
    + ")"
)
_NUM = r"try_cast(regexp_replace(regexp_replace({c}, '[\s, ]', '', 'g'), '\.0*$', '') AS BIGINT)"
_P4 = f"""
WITH refs AS (
  SELECT 'decisions' AS ref_table, decision_id AS ref_key, {_NUM.format(c='row_id')} AS k, decided_at AS seen FROM decisions
  UNION ALL SELECT 'apply_accepted', cell_id, {_NUM.format(c='row_id')}, accepted_at FROM apply_accepted
  UNION ALL SELECT 'verify_report', check_id, {_NUM.format(c='row_id')}, checked_at FROM verify_report),
parents AS (SELECT {_NUM.format(c='row_id')} AS k, min(loaded_at) AS l, min(deleted_at) AS d FROM apply_rows GROUP BY 1),
j AS (SELECT refs.*, parents.k AS pk, l, d FROM refs LEFT JOIN parents ON refs.k = parents.k WHERE refs.k IS NOT NULL),
found AS (
  SELECT DISTINCT ref_table, ref_key, strftime(seen, '%Y-%m') AS period, reason FROM (
    SELECT *, 'missing' AS reason FROM j WHERE pk IS NULL
    UNION ALL SELECT *, 'deleted' FROM j WHERE d <= seen
    UNION ALL SELECT *, 'late' FROM j WHERE l > seen))
"""

ORACLES = {
    "p1_found": _P1 + "SELECT raw_id, reason FROM (SELECT raw_id, unnest(r) AS reason FROM reasons) WHERE reason IS NOT NULL",
    "p1_loaded": _P1
    + """SELECT v.raw_id, f[1] AS row_id, f[4] AS vessel_name, f[24] AS yard_location_longitude, f[28] AS capacity, f[40] AS operator_charterer,
  CASE WHEN lower(p.cap) NOT IN ('', 'unknown') THEN try_cast(replace(p.cap, ',', '') AS DOUBLE) END AS capacity_number,
  CASE WHEN lower(p.lon) NOT IN ('', 'unknown') THEN try_cast(p.lon AS DOUBLE) END AS longitude_degrees
FROM vals v JOIN reasons p USING (raw_id) WHERE len([x FOR x IN p.r IF x IS NOT NULL]) = 0""",
    "p3_found": _P3_FOUND + " SELECT * FROM found",
    "p3_summary": _P3_FOUND + " SELECT kind, field, count(*) AS checks FROM found GROUP BY kind, field",
    "p4_found": _P4 + "SELECT * FROM found",
    "p4_report": _P4 + "SELECT ref_table, period, reason, count(*) AS refs FROM found GROUP BY ALL",
}
