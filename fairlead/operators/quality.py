"""Quality rules over a wide sheet: findings (row, column, value, check, severity).

A rule is (check, severity, function of a cell's column name and value to a condition). Rules on single cells are
evaluated in one pass without a shuffle: each row yields the array of its findings, which is inlined. Only the rules
that compare rows or need a dimension join anything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from fairlead.functions.parse import NUMBER, date_int, number, placeholder_parts
from fairlead.functions.text import looks_url, strip
from fairlead.operators.skew import skew_join
from fairlead.schema import COORDINATES, COORDINATES_REF, REF_COLUMNS, REF_OF, VALUE_COLUMNS

HIGH, MED, LOW = "HIGH", "MED", "LOW"
FINDING = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("column_name", "value", "check_name", "severity")]))
KEYS = ["record_id", "row_id"]

# Shapes of dates that the date reader does not know, and bracketed tails that are no number of a series.
MONTH_WORD = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
OTHER_DATES = [rf"(?i)^\d{{1,2}}[-\s]{MONTH_WORD}[-\s]\d{{4}}$", rf"(?i)^{MONTH_WORD}[-\s.,]*\d{{4}}$", r"^\d{4}([-/]\d{1,2})?$"]
DESCRIPTOR_TAILS = ["unknown", "owner unknown", "shipowner unknown", "fsru", "tbd"]


@dataclass(frozen=True)
class Rule:
    """A check on the cells of ``columns``: it fails where ``fails(column name, stripped non-blank value)`` is true."""

    check: str
    severity: str
    columns: tuple[str, ...]
    fails: Callable[[Column, Column], Column]


def vocabulary(vocab: DataFrame, most: int = 100_000) -> dict[str, set[str]]:
    """column -> its terms, of a table (column_name, term) of what people pick from; the size is checked."""
    rows = vocab.select("column_name", "term").where("column_name is not null and term is not null").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} vocabulary terms")
    out: dict[str, set[str]] = {}
    for r in rows:
        out.setdefault(r.column_name, set()).add(r.term)
    return out


def _outside(v: Column, low: float, high: float) -> Column:
    return ~F.coalesce(number(v).between(low, high), F.lit(False))


def _no_year(v: Column) -> Column:
    years = F.transform(F.regexp_extract_all(v, F.lit(r"(\d{4})"), F.lit(1)), lambda y: y.cast("int"))
    return ~(v.rlike(r"^\d{4}(\s*[-/]\s*\d{4})?$") & F.forall(years, lambda y: y.between(1900, 2100)))


def _no_date(v: Column) -> Column:
    good = date_int(v).isNotNull()
    for pattern in OTHER_DATES:
        good = good | v.rlike(pattern)
    return ~good


def cell_rules(terms: dict[str, set[str]]) -> list[Rule]:
    """The rules on single cells, for a vocabulary."""
    owners: dict[str, set[str]] = {}
    for column, values in terms.items():
        for v in values:
            owners.setdefault(v.lower(), set()).add(column)

    owned = F.create_map(*[x for t in sorted(owners) for x in (F.lit(t), F.array(*[F.lit(c) for c in sorted(owners[t])]))]) if owners else None

    def misplaced(column: Column, v: Column) -> Column:
        if owned is None:
            return F.lit(False)
        return F.lower(v).isin(sorted(owners)) & ~F.array_contains(owned[F.lower(v)], column)

    def data_in_ref(_: Column, v: Column) -> Column:
        def is_data(p: Column) -> Column:
            s = strip(p)
            year = s.rlike(r"^\d{4}$") & F.coalesce(s.try_cast("int").between(1900, 2100), F.lit(False))
            return (s != "") & ~looks_url(p) & (F.lower(s).isin(sorted(owners)) | year | date_int(s).isNotNull() | s.rlike(r"^[\d,]{3,}$"))

        return F.exists(F.split(v, ", "), is_data)

    off = lambda column: lambda _, v: ~v.isin(sorted(terms.get(column, set())))
    return [
        Rule("misplaced-vocab", HIGH, tuple(VALUE_COLUMNS), misplaced),
        Rule("misplaced-in-ref", HIGH, tuple(REF_COLUMNS), data_in_ref),
        Rule("url-in-value", HIGH, tuple(VALUE_COLUMNS), lambda _, v: looks_url(v)),
        Rule("bad-shape", HIGH, ("yard_location_latitude",), lambda _, v: _outside(v, -90, 90)),
        Rule("bad-shape", HIGH, ("yard_location_longitude",), lambda _, v: _outside(v, -180, 180)),
        Rule("bad-shape", MED, ("capacity", "imo_number"), lambda _, v: number(v).isNull()),
        Rule("bad-shape", MED, ("delivery_year",), lambda _, v: _no_year(v)),
        Rule("bad-shape", MED, ("contract_date",), lambda _, v: _no_date(v)),
        Rule("bad-shape", MED, ("capacity_units",), off("capacity_units")),
        Rule("bad-shape", MED, ("price_currency",), off("price_currency")),
    ]


def cell_findings(sheet: DataFrame, rules: list[Rule]) -> DataFrame:
    """Findings of single-cell rules. Blank cells pass; columns that the sheet lacks are skipped."""
    names = [c for c in sheet.columns if c in {x for r in rules for x in r.columns}]
    own = sheet.select(*KEYS, *[strip(F.col(c)).alias(f"_c_{c}") for c in names])

    def of(rule: Rule) -> Column | None:
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_c_{c}").alias("value")) for c in rule.columns if c in names]
        if not cells:
            return None
        bad = F.filter(F.array(*cells), lambda x: (x["value"] != "") & rule.fails(x["column_name"], x["value"]))
        return F.transform(bad, lambda x: F.struct(x["column_name"].alias("column_name"), x["value"].alias("value"), F.lit(rule.check).alias("check_name"), F.lit(rule.severity).alias("severity")))

    made = [m for m in map(of, rules) if m is not None]
    found = F.concat(*made) if made else F.array().cast(FINDING)
    return own.select(*KEYS, F.inline(found))


def pair_findings(sheet: DataFrame) -> DataFrame:
    """orphan-ref (a reference without its value; coordinates share one) and missing-pair (a quantity without its unit)."""
    s = {c: strip(F.col(c)) for c in sheet.columns}
    finding = lambda c, v, check, severity: F.struct(F.lit(c).alias("column_name"), v.alias("value"), F.lit(check).alias("check_name"), F.lit(severity).alias("severity"))
    made = []
    for value, ref in [*REF_OF.items(), (None, COORDINATES_REF)]:
        base = [value] if value else COORDINATES
        if ref in s and all(b in s for b in base):
            empty = F.lit(True)
            for b in base:
                empty = empty & (s[b] == "")
            made.append(F.when((s[ref] != "") & empty, finding(ref, s[ref], "orphan-ref", MED)))
    for quantity, unit in (("capacity", "capacity_units"), ("price", "price_currency")):
        if quantity in s and unit in s:
            made.append(F.when((s[quantity] != "") & (s[unit] == ""), finding(unit, F.lit(""), "missing-pair", LOW)))
    return sheet.select(*KEYS, F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))


def lookup_mismatch(sheet: DataFrame, tag: str, facts: DataFrame, column: str) -> DataFrame:
    """Cells of ``column`` that differ from the usable fact (tag, value) of the row's ``tag``; blank on either side passes."""
    known = facts.where("value <> '' and value <> 'AMBIGUOUS'").select(F.col("tag").alias("_t"), F.col("value").alias("_fact"))
    own = sheet.select(*KEYS, F.col(tag).alias("_t"), strip(F.col(column)).alias("value")).where("value <> '' and _t <> ''")
    hit = skew_join(own, known, "_t").where(F.col("value") != F.col("_fact"))
    return hit.select(*KEYS, F.lit(column).alias("column_name"), "value", F.lit("lookup-mismatch").alias("check_name"), F.lit(MED).alias("severity"))


def coverage_gap(sheet: DataFrame, tag: str, facts: DataFrame, kind: str) -> DataFrame:
    """(kind, tag) of the distinct tags that the facts lack."""
    return sheet.where(F.col(tag) != "").select(F.col(tag).alias("tag")).distinct().join(facts.select("tag").distinct(), "tag", "left_anti").select(F.lit(kind).alias("kind"), "tag")


def column_offset(findings: DataFrame, least: int = 3) -> DataFrame:
    """A finding for each record with findings in ``least`` or more distinct columns: its cells have probably slipped."""
    n = findings.groupBy(*KEYS).agg(F.count_distinct("column_name").alias("n")).where(F.col("n") >= least)
    return n.select(*KEYS, F.lit("").alias("column_name"), F.lit("").alias("value"), F.lit("column-offset").alias("check_name"), F.lit(HIGH).alias("severity"))


def name_findings(sheet: DataFrame, tag: str) -> DataFrame:
    """name-builder-drift and name-ordinal-gap of placeholder names 'Label (inner)', with the other labels joined by '; '.

    The labels of a tag and the state of a (tag, owner) cluster are aggregated and joined back, so that no cluster is
    ever held in one place; how many labels a tag has is bounded by how it is spelled, not by the rows.
    """
    ph = sheet.select(*KEYS, strip(F.col("vessel_name")).alias("value"), placeholder_parts(F.col("vessel_name")).alias("p"), F.col(tag).alias("tag"), strip(F.col("shipowner")).alias("owner")).where("p is not null")
    ph = ph.select(*KEYS, "value", "p.label", "p.inner", "tag", "owner").withColumn("cluster", F.concat_ws("|", "tag", "owner"))
    labels = ph.where("tag <> ''").select("tag", "label").distinct().groupBy("tag").agg(F.array_sort(F.collect_list("label")).alias("labels")).where(F.size("labels") > 1)
    drift = skew_join(ph, labels, "tag").withColumn("others", F.array_join(F.array_remove("labels", F.col("label")), "; "))
    numbered = F.col("inner").rlike(r"\d\s*$")
    clusters = ph.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max(numbered.cast("int")).alias("some")).where("n > 1 and some = 1").select("cluster")
    gap = skew_join(ph.where(~numbered & ~F.lower("inner").isin(DESCRIPTOR_TAILS)), clusters, "cluster")
    done = lambda df, check, detail: df.select(*KEYS, F.lit("vessel_name").alias("column_name"), "value", F.lit(check).alias("check_name"), F.lit(LOW).alias("severity"), detail.alias("detail"))
    return done(drift, "name-builder-drift", F.col("others")).unionByName(done(gap, "name-ordinal-gap", F.col("inner")))


def without_allowed(findings: DataFrame, allowed: DataFrame) -> DataFrame:
    """Findings not on the allowlist (row_id, column_name); column '' silences findings on the whole row only."""
    keys = allowed.select(strip(F.col("row_id")).alias("_r"), strip(F.col("column_name")).alias("column_name")).distinct()
    return findings.withColumn("_r", strip(F.col("row_id"))).join(keys, ["_r", "column_name"], "left_anti").drop("_r")


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("check_name", "severity").agg(F.count(F.lit(1)).alias("findings"), F.count_distinct("record_id").alias("records"))


def any_of(findings: DataFrame, severities: list[str]) -> bool:
    """Whether there is a finding of these severities: stops at the first one."""
    return not findings.where(F.col("severity").isin(severities)).limit(1).isEmpty()


def latest_rows(rows: DataFrame, key: str = "row_id", order: str = "loaded_at", tie: str = "record_id") -> DataFrame:
    """The last row of each non-blank key, by ``order``, then ``tie``."""
    own = rows.where(strip(F.col(key)) != "")
    last = own.groupBy(key).agg(F.max(F.struct(order, tie)).alias("_m")).select(F.col(f"_m.{tie}").alias(tie))
    return own.join(last, tie, "left_semi")


def labelled_runs(rows: DataFrame, cluster: list[str], date: str, tie: str, most_days: int = 30) -> DataFrame:
    """rows with run, counted from 1: a gap of more than ``most_days`` in ``date`` starts a new run within a cluster.

    A cluster is one order's rows; a cluster that holds a large share of the table would sit in one task here, so pass
    keys as fine as an order.
    """
    w = W.partitionBy(*cluster).orderBy(date, tie)
    gap = F.coalesce((F.datediff(F.col(date), F.lag(date).over(w)) > most_days).cast("int"), F.lit(1))
    return rows.withColumn("_new", gap).withColumn("run", F.sum("_new").over(w).cast("int")).drop("_new")


NUMERIC = NUMBER
