"""Queries of the sheet operators over the tracker's tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.functions import parse as P
from fairlead.functions import text as X
from fairlead.operators import dedupe, lookup, patch, proposals, quality, reconcile
from fairlead.operators.orphans import whole_number
from fairlead.plans.problems import RAW_VALUES
from fairlead.schema import COORDINATES, REF_COLUMNS, REF_OF, SHEET_COLUMNS, YARD_BLOCK, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


# ---- SQL that several queries share -------------------------------------------------------------------------------


def S(c: str) -> str:
    return rf"regexp_replace(coalesce({c}, ''), '^\s+|\s+$', '', 'g')"


def SQ(c: str) -> str:
    return S(rf"regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')")


def CLEAN(c: str) -> str:
    inner = S(f"lower({c})")
    return SQ(rf"regexp_replace({inner}, '\([^)]*\)', '', 'g')")


def NUM(c: str) -> str:
    bare = f"replace({S(c)}, ',', '')"
    return rf"CASE WHEN regexp_full_match({bare}, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN try_cast({bare} AS DOUBLE) END"


IS_DATE = r"regexp_matches({v}, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}|^\d{{4}}-\d{{1,2}}-\d{{1,2}}|^\d{{1,2}}[-\s][A-Za-z]{{3}}[-\s]\d{{4}}')"
MONTH_NO = "list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower({m}))"


def DATE(c: str) -> str:
    s, e = S(c), lambda p, k: rf"try_cast(regexp_extract({S(c)}, '{p}', {k}) AS INT)"
    us, iso, named = r"^(\d{1,2})/(\d{1,2})/(\d{4})", r"^(\d{4})-(\d{1,2})-(\d{1,2})", r"^(\d{1,2})[-\s]([A-Za-z]{3})[-\s](\d{4})"
    month = MONTH_NO.format(m=f"regexp_extract({s}, '{named}', 2)")
    return f"CASE WHEN regexp_matches({s}, '{us}') THEN {e(us, 3)} * 10000 + {e(us, 1)} * 100 + {e(us, 2)} WHEN regexp_matches({s}, '{iso}') THEN {e(iso, 1)} * 10000 + {e(iso, 2)} * 100 + {e(iso, 3)} WHEN regexp_matches({s}, '{named}') THEN {e(named, 3)} * 10000 + coalesce({month}, 0) * 100 + {e(named, 1)} END"


def MONTH(c: str) -> str:
    s = S(c)
    iso, named, short = r"^(\d{4})-(\d{1,2})", r"^\d{1,2}[-\s]([A-Za-z]{3})[-\s](\d{4})", r"^([A-Za-z]{3})\s+(\d{4})"
    no = lambda p: f"coalesce({MONTH_NO.format(m=f"regexp_extract({s}, '{p}', 1)")}, 0)"
    two = lambda x: f"lpad(CAST({x} AS VARCHAR), 2, '0')"
    iso_month = two(f"try_cast(regexp_extract({s}, '{iso}', 2) AS INT)")
    return (
        f"CASE WHEN regexp_matches({s}, '{iso}') THEN regexp_extract({s}, '{iso}', 1) || '-' || {iso_month}"
        + "".join(f" WHEN regexp_matches({s}, '{p}') AND {no(p)} > 0 THEN regexp_extract({s}, '{p}', 2) || '-' || {two(no(p))}" for p in (named, short))
        + rf" WHEN regexp_matches({s}, '^\d{{4}}$') THEN {s} || '-00' ELSE '' END"
    )


_WHOLE = r"CASE WHEN regexp_full_match(regexp_replace(regexp_replace({c}, '[\s, ]', '', 'g'), '\.0*$', ''), '[+-]?\d{{1,18}}') THEN try_cast(regexp_replace(regexp_replace({c}, '[\s, ]', '', 'g'), '\.0*$', '') AS BIGINT) END"
CELLS = "cells AS (" + " UNION ALL ".join(f"SELECT record_id, row_id, '{c}' AS column_name, {S(c)} AS value FROM apply_rows" for c in SHEET_COLUMNS) + ")"
TAGGED = (
    "owner_alias AS (SELECT row_number() OVER (ORDER BY owner_tag) AS o, owner_tag AS k FROM shipowner_facts), builder_alias AS (SELECT row_number() OVER (ORDER BY builder_tag) AS o, builder_tag AS k FROM shipbuilder_facts),"
    f" owner_names AS (SELECT DISTINCT coalesce(shipowner, '') AS raw, {CLEAN('shipowner')} AS c FROM apply_rows), builder_names AS (SELECT DISTINCT coalesce(shipbuilder, '') AS raw, {CLEAN('shipbuilder')} AS c FROM apply_rows),"
    " owner_tags AS (SELECT raw, coalesce(arg_min(k, o), any_value(c)) AS tag FROM owner_names LEFT JOIN owner_alias ON contains(c, k) GROUP BY raw), builder_tags AS (SELECT raw, coalesce(arg_min(k, o), any_value(c)) AS tag FROM builder_names LEFT JOIN builder_alias ON contains(c, k) GROUP BY raw),"
    " sheet AS (SELECT a.*, o.tag AS owner_tag, b.tag AS builder_tag FROM apply_rows a JOIN owner_tags o ON coalesce(a.shipowner, '') = o.raw JOIN builder_tags b ON coalesce(a.shipbuilder, '') = b.raw)"
)


def rows_of(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "apply_rows")


def owner_aliases(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    return lookup.alias_list(table(spark, sf, "shipowner_facts").select(F.col("owner_tag").alias("ord"), F.col("owner_tag").alias("key"), F.col("owner_tag").alias("tag")))


def builder_aliases(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    return lookup.alias_list(table(spark, sf, "shipbuilder_facts").select(F.col("builder_tag").alias("ord"), F.col("builder_tag").alias("key"), F.col("builder_tag").alias("tag")))


def tagged(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The sheet with owner_tag and builder_tag."""
    df = rows_of(spark, sf)
    if columns:
        df = df.select(*dict.fromkeys([*columns, "shipowner", "shipbuilder"]))
    return lookup.tag_names(df, {("shipowner", "owner_tag"): owner_aliases(spark, sf), ("shipbuilder", "builder_tag"): builder_aliases(spark, sf)})


# ---- scalar functions ---------------------------------------------------------------------------------------------


@query(f"SELECT record_id, {CLEAN('shipowner')} AS owner, {CLEAN('shipbuilder')} AS builder FROM apply_rows")
def x01_clean_names(spark, sf):
    return rows_of(spark, sf).select("record_id", X.clean_org(F.col("shipowner")).alias("owner"), X.clean_org(F.col("shipbuilder")).alias("builder"))


@query(f"WITH {TAGGED} SELECT record_id, owner_tag, builder_tag FROM sheet")
def x02_name_tags(spark, sf):
    return tagged(spark, sf, "record_id").select("record_id", "owner_tag", "builder_tag")


_HULL = "regexp_replace(" + S("lower(hull_number)") + ", '^(" + "|".join(lookup.HULL_PREFIXES) + ")', '')"


@query(f"SELECT record_id, {S(_HULL)} AS hull FROM apply_rows")
def x04_hull_key(spark, sf):
    return rows_of(spark, sf).select("record_id", lookup.hull_key(F.col("hull_number")).alias("hull"))


@query("SELECT record_id, strip_accents(coalesce(vessel_name, '')) AS folded FROM apply_rows")
def x05_fold_accents(spark, sf):
    return rows_of(spark, sf).select("record_id", X.fold_accents(F.coalesce("vessel_name", F.lit(""))).alias("folded"))


VESSEL_KEY = lambda c: SQ(rf"""regexp_replace(regexp_replace(lower(strip_accents(coalesce({c}, ''))), '\([^)]*\)', ' ', 'g'), '["''`]', '', 'g')""")


@query(f"SELECT record_id, {VESSEL_KEY('vessel_name')} AS name_key FROM apply_rows")
def x06_vessel_key(spark, sf):
    return rows_of(spark, sf).select("record_id", X.vessel_key(F.coalesce("vessel_name", F.lit(""))).alias("name_key"))


_PIECES = r"regexp_split_to_array(lower(strip_accents(coalesce(vessel_owner, ''))), '[,/&]| and ')"


@query(
    "WITH alias AS (SELECT row_number() OVER (ORDER BY owner_tag) AS o, owner_tag AS k FROM shipowner_facts), "
    f"p AS (SELECT fleet_id, unnest({_PIECES}) AS raw FROM giignl_fsru_fleet), c AS (SELECT fleet_id, {SQ(r"regexp_replace(raw, '\([^)]*\)', ' ', 'g')")} AS c FROM p), "
    "t AS (SELECT DISTINCT fleet_id, c, coalesce((SELECT arg_min(k, o) FROM alias WHERE contains(c, k)), c) AS tag FROM c WHERE c <> '') "
    "SELECT f.fleet_id, coalesce(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags FROM giignl_fsru_fleet f LEFT JOIN t USING (fleet_id) GROUP BY f.fleet_id"
)
def x07_owner_tag_sets(spark, sf):
    tags = lookup.lessor_tags(F.col("vessel_owner"), owner_aliases(spark, sf))
    return table(spark, sf, "giignl_fsru_fleet").select("fleet_id", F.array_join(tags, "|").alias("tags"))


@query(f"SELECT record_id, CAST({DATE('contract_date')} AS INT) AS date_int FROM apply_rows")
def x08_date_int(spark, sf):
    return rows_of(spark, sf).select("record_id", P.date_int(F.col("contract_date")).alias("date_int"))


@query(f"SELECT record_id, {MONTH('contract_date')} AS month FROM apply_rows")
def x09_contract_month(spark, sf):
    return rows_of(spark, sf).select("record_id", P.month_key(F.col("contract_date")).alias("month"))


@query(
    rf"SELECT record_id, {NUM('capacity')} AS n, CASE WHEN regexp_full_match(replace({S('capacity')}, ',', ''), '[+-]?\d{{1,18}}') THEN try_cast(replace({S('capacity')}, ',', '') AS BIGINT) END AS w,"
    r" regexp_replace(coalesce(imo_number, ''), '[^0-9]', '', 'g') AS d, regexp_extract(coalesce(delivery_year, ''), '((?:19|20)\d{2})', 1) AS y FROM apply_rows"
)
def x10_numbers(spark, sf):
    return rows_of(spark, sf).select("record_id", P.number(F.col("capacity")).alias("n"), P.whole(F.col("capacity")).alias("w"), P.digits(F.col("imo_number")).alias("d"), P.year(F.col("delivery_year")).alias("y"))


BUCKET = "CAST(round_even(try_cast(nullif(regexp_replace(coalesce(capacity, ''), '[^0-9]', '', 'g'), '') AS DOUBLE) / 10000, 0) * 10000 AS BIGINT)"


@query(f"SELECT record_id, {BUCKET} AS bucket FROM apply_rows")
def x11_size_bucket(spark, sf):
    return rows_of(spark, sf).select("record_id", P.size_bucket(F.col("capacity")).alias("bucket"))


def _marks(c: str) -> str:
    low, words = f"lower({S(c)})", P.ORDINAL_WORDS
    lists = ["[" + ", ".join(f"CASE WHEN regexp_matches({low}, '\\b{w}\\b') THEN {k} END" for k, w in enumerate(words, 1)) + "]"]
    for s, p in ((low, r"\b(\d{1,2})(?:st|nd|rd|th)\b"), (low, r"\b(?:ship|vessel|unit|hull|no\.?)\s*[-#]?\s*(\d{1,2})\b"), (S(c), r"-(\d{2})\b"), (S(c), r"(?:^|[^0-9])(\d{1,2})\s*\)?\s*$")):
        lists.append(f"[CAST(x AS INT) FOR x IN regexp_extract_all({s}, '{p}', 1)]")
    return " || ".join(lists)


MARKS = f"list_sort(list_distinct([x FOR x IN {' || '.join(_marks(c) for c in ('vessel_name', 'hull_number', 'original_source'))} IF x IS NOT NULL]))"


@query(f"SELECT record_id, array_to_string({MARKS}, ',') AS marks FROM apply_rows")
def x12_ordinals(spark, sf):
    return dedupe.keyed_rows(rows_of(spark, sf).withColumn("builder_tag", F.lit("")).withColumn("owner_tag", F.lit(""))).select("record_id", F.array_join("marks", ",").alias("marks"))


PARTS = rf"regexp_full_match({S('vessel_name')}, '(?s)(.+)\(([^(]*)\)') AND {S(rf"regexp_extract({S('vessel_name')}, '(?s)^(.+)\(([^(]*)\)$', 1)")} <> '' AND NOT regexp_matches({S(rf"regexp_extract({S('vessel_name')}, '(?s)^(.+)\(([^(]*)\)$', 1)")}, '(?i)^hull\b')"
LABEL, INNER = (S(rf"regexp_extract({S('vessel_name')}, '(?s)^(.+)\(([^(]*)\)$', {k})") for k in (1, 2))


@query(f"SELECT record_id, {LABEL} AS label, {INNER} AS tail FROM apply_rows WHERE {PARTS}")
def x14_placeholder_names(spark, sf):
    return rows_of(spark, sf).select("record_id", P.placeholder_parts(F.col("vessel_name")).alias("p")).where("p is not null").select("record_id", "p.label", F.col("p.inner").alias("tail"))


SPLIT_REFS = lambda c: rf"[{S('x')} FOR x IN string_split(regexp_replace(coalesce({c}, ''), '\r?\n', ', ', 'g'), ', ') IF {S('x')} <> '']"


@query(f"SELECT record_id, CAST(len({SPLIT_REFS('vessel_name_ref')}) AS INT) AS n, array_to_string({SPLIT_REFS('vessel_name_ref')}, ' ~ ') AS links FROM apply_rows")
def x15_split_refs(spark, sf):
    links = X.split_refs(F.col("vessel_name_ref"))
    return rows_of(spark, sf).select("record_id", F.size(links).alias("n"), F.array_join(links, " ~ ").alias("links"))


@query(
    f"WITH l AS (SELECT record_id, {SPLIT_REFS('vessel_name_ref')} || {SPLIT_REFS('hull_number_ref')} AS l FROM apply_rows), u AS (SELECT record_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM l), "
    "f AS (SELECT record_id, x, min(i) AS i FROM u GROUP BY ALL) SELECT r.record_id, coalesce(string_agg(x, ', ' ORDER BY i), '') AS links FROM apply_rows r LEFT JOIN f USING (record_id) GROUP BY r.record_id"
)
def x16_joined_refs(spark, sf):
    return rows_of(spark, sf).select("record_id", X.join_refs(F.col("vessel_name_ref"), X.split_refs(F.col("hull_number_ref"))).alias("links"))


@query(f"SELECT cell_id, loaded_at, {SQ('accepted_value')} AS value FROM apply_accepted")
def x17_squash(spark, sf):
    return table(spark, sf, "apply_accepted").select("cell_id", "loaded_at", X.squash(F.col("accepted_value")).alias("value"))


def _compact(x: str) -> str:
    places = f"greatest(6 - greatest(floor(log10(greatest(abs({x}), 1e-9))) + 1, 1), 0)"
    return rf"regexp_replace(regexp_replace(printf('%.6f', round({x} * pow(10.0, {places})) / pow(10.0, {places})), '0+$', ''), '\.$', '')"


def variants_of(source: str, keys: str) -> str:
    """CTEs up to var(keys, v, l): the renderings l of each value v of ``source``, a select of keys and v."""
    raw = r"regexp_extract(v, '^\$?\s*([\d,]+(?:\.\d+)?)', 1)"
    forms = lambda x, a, b: f"['' || {_compact(x)} || '{a}', '$' || {_compact(x)} || '{a}', {_compact(x)} || ' {b}']"
    return (
        f"val AS ({source}), num AS (SELECT *, try_cast(replace({raw}, ',', '') AS DOUBLE) AS n FROM val), whole AS (SELECT *, n = floor(n) AS w FROM num), "
        f"listed AS (SELECT {keys}, v, [v, lower(v), CASE WHEN n IS NULL THEN NULL WHEN w THEN printf('%.0f', n) ELSE CAST(n AS VARCHAR) END, CASE WHEN w THEN format('{{:,}}', CAST(n AS BIGINT)) END]"
        f" || CASE WHEN w AND n >= 1e6 THEN {forms('(n / 1e6)', 'm', 'million')} || {forms('round_even(n / 1e6, 0)', 'm', 'million')} ELSE [] END"
        f" || CASE WHEN w AND n >= 1e9 THEN {forms('(n / 1e9)', 'bn', 'billion')} || {forms('round_even(n / 1e9, 2)', 'bn', 'billion')} ELSE [] END AS l FROM whole), "
        f"var AS (SELECT {keys}, v, list_distinct([x FOR x IN l IF x <> '']) AS l FROM listed)"
    )


@query("WITH " + variants_of(f"SELECT cell_id, loaded_at, {S('accepted_value')} AS v FROM apply_accepted", "cell_id, loaded_at") + " SELECT cell_id, loaded_at, array_to_string(list_sort(l), ' ~ ') AS variants FROM var")
def x18_value_variants(spark, sf):
    return table(spark, sf, "apply_accepted").select("cell_id", "loaded_at", F.array_join(F.array_sort(P.value_variants(F.col("accepted_value"))), " ~ ").alias("variants"))


@query("SELECT record_id, translate(coalesce(hull_number, ''), '－‐‑﹣', '----') AS hull FROM apply_rows")
def x23_fold_hyphens(spark, sf):
    return rows_of(spark, sf).select("record_id", X.fold_hyphens(F.coalesce("hull_number", F.lit(""))).alias("hull"))


@query(rf"SELECT CASE WHEN d = '' THEN 'blank' WHEN regexp_matches(d, '^[89]\d{{6}}$') THEN 'real' WHEN regexp_matches(d, '^11\d{{5}}$') THEN 'synthetic' ELSE 'other' END AS kind, count(*) AS records FROM (SELECT {S('imo_number')} AS d FROM apply_rows) GROUP BY 1")
def x24_id_classes(spark, sf):
    return rows_of(spark, sf).groupBy(P.id_class(F.col("imo_number")).alias("kind")).agg(F.count(F.lit(1)).alias("records"))


# ---- scans and keys -----------------------------------------------------------------------------------------------


@query(f"SELECT record_id, row_id, vessel_name FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC, record_id DESC) AS k FROM apply_rows WHERE {S('row_id')} <> '') WHERE k = 1")
def s03_latest_rows(spark, sf):
    return quality.latest_rows(rows_of(spark, sf)).select("record_id", "row_id", "vessel_name")


@query(f"SELECT record_id, {VESSEL_KEY('vessel_name')} AS name_key, {S('imo_number')} AS imo, CASE WHEN regexp_full_match(replace({S('capacity')}, ',', ''), '[+-]?\\d{{1,18}}') THEN try_cast(replace({S('capacity')}, ',', '') AS BIGINT) END AS size, {S('vessel_type')} AS vessel_type FROM apply_rows WHERE {S('vessel_name')} <> ''")
def s05_reconcile_records(spark, sf):
    s = lambda c: X.strip(F.col(c))
    return rows_of(spark, sf).where(s("vessel_name") != "").select("record_id", X.vessel_key(F.col("vessel_name")).alias("name_key"), s("imo_number").alias("imo"), P.whole(F.col("capacity")).alias("size"), s("vessel_type").alias("vessel_type"))


@query(f"SELECT {S('owner_tag')} AS owner_tag, max({S('shipowner_country_area')}) AS country FROM shipowner_facts WHERE {S('owner_tag')} <> '' GROUP BY 1")
def s08_facts(spark, sf):
    return lookup.facts_table(table(spark, sf, "shipowner_facts").select("owner_tag", F.col("shipowner_country_area").alias("country")), "owner_tag")


_ERR = "coalesce(" + ", ".join(f"CASE WHEN contains(value, '{e}') THEN '{e}' END" for e in ("#REF!", "#DIV/0!", "#VALUE!", "#NAME?", "#NULL!", "#N/A", "#NUM!")) + ")"


@query(f"WITH {CELLS} SELECT record_id, column_name, {_ERR} AS error FROM cells WHERE {_ERR} IS NOT NULL")
def s19_cell_errors(spark, sf):
    from fairlead.sources.sheet import cell_errors

    return cell_errors(rows_of(spark, sf), "record_id", SHEET_COLUMNS)


_ORDER_HTML = (
    "concat('<tr><td>', CAST(record_id % 900 AS STRING), '</td><td><a href=\"ship.aspx?', CAST(record_id AS STRING), '\">', replace(replace(coalesce(nullif(hull_number, ''), 'yard'), '&', '&amp;'), '<', '&lt;'), '</a></td><td>',"
    " CASE WHEN vessel_type = 'FSRU' THEN 'FSRU ' WHEN record_id % 7 = 0 THEN 'LNG Bunker ' ELSE 'LNG Tanker ' END, replace(coalesce(capacity, ''), '<', ''), '</td><td>', replace(replace(coalesce(shipowner, ''), '&', '&amp;'), '<', '&lt;'), '</td><td> ',"
    " coalesce(delivery_year, ''), ' - 06 </td><td>', coalesce(delivery_year, ''), ' - 01</td></tr>')"
)


def _order_pages(spark, sf):
    return rows_of(spark, sf).select(F.concat_ws("-", F.lit("yard"), F.pmod("record_id", F.lit(97))).alias("yard"), F.expr(_ORDER_HTML).alias("html"))


@query(
    f"SELECT 'yard-' || CAST(record_id % 97 AS VARCHAR) AS yard, CAST(record_id % 900 AS INT) AS row_num, CAST(record_id AS VARCHAR) AS ship_token, translate({S("coalesce(nullif(hull_number, ''), 'yard')")}, '－‐‑﹣', '----') AS hull, regexp_matches({S("coalesce(nullif(hull_number, ''), 'yard')")}, '[0-9]') AS hull_assigned,"
    f" {S("CASE WHEN vessel_type = 'FSRU' THEN 'FSRU ' WHEN record_id % 7 = 0 THEN 'LNG Bunker ' ELSE 'LNG Tanker ' END || replace(coalesce(capacity, ''), '<', '')")} AS typecap, {S('shipowner')} AS owner,"
    f" replace({S('delivery_year')}, ' ', '') || '-06' AS delivery, replace({S('delivery_year')}, ' ', '') || '-01' AS contract FROM apply_rows WHERE vessel_type = 'FSRU' OR record_id % 7 <> 0"
)
def s14_order_rows(spark, sf):
    from fairlead.sources.pages import order_filter, order_rows

    return order_filter(order_rows(_order_pages(spark, sf)), relevant=True)


@query(f"WITH r AS (SELECT 'yard-' || CAST(record_id % 97 AS VARCHAR) AS yard, replace({S('delivery_year')}, ' ', '') || '-01' AS contract FROM apply_rows) SELECT yard, min(contract) > '2014-01' AS more FROM r WHERE contract <> '' GROUP BY yard")
def f20_more_pages(spark, sf):
    from fairlead.sources.pages import more_pages, order_rows

    return more_pages(order_rows(_order_pages(spark, sf)), "2014-01")


# ---- quality rules ------------------------------------------------------------------------------------------------


def _rules(spark, sf):
    return quality.cell_rules(quality.vocabulary(table(spark, sf, "vocab")))


def intake(spark, sf) -> DataFrame:
    """The sheet's rows and the raw records that have all columns, sound or not: what rules on cells are for."""
    from fairlead.sources.raw_records import with_fields

    raw = with_fields(table(spark, sf, "apply_rows_raw").select("raw_id", "raw_line")).where((F.size("_fields") == len(SHEET_COLUMNS)) & F.col("_fault").isNull())
    new = raw.select(F.col("raw_id").alias("record_id"), *[F.element_at("_fields", k).alias(c) for k, c in enumerate(SHEET_COLUMNS, 1)])
    return rows_of(spark, sf).select("record_id", *SHEET_COLUMNS).unionByName(new)


INTAKE = RAW_VALUES + ", intake AS (SELECT record_id, " + ", ".join(SHEET_COLUMNS) + " FROM apply_rows UNION ALL SELECT raw_id, " + ", ".join(f"f[{k}]" for k in range(1, len(SHEET_COLUMNS) + 1)) + " FROM vals WHERE ok AND n = 46)"
INTAKE_CELLS = INTAKE + ", " + CELLS.replace("apply_rows", "intake")


def _cells(spark, sf, check: str, columns: list[str] | None = None):
    rules = [r for r in _rules(spark, sf) if r.check == check and (columns is None or set(r.columns) & set(columns))]
    need = {c for r in rules for c in r.columns}
    return quality.cell_findings(intake(spark, sf).select("record_id", "row_id", *[c for c in SHEET_COLUMNS if c in need and c != "row_id"]), rules)


_IN = lambda cs: "(" + ", ".join(f"'{c}'" for c in cs) + ")"
_OUT = "SELECT record_id, row_id, column_name, value, '{check}' AS check_name, '{sev}' AS severity FROM cells WHERE value <> '' AND "
_VOCAB_LOW = "(SELECT lower(term) FROM vocab)"
_Q = {
    "q01": _OUT.format(check="misplaced-vocab", sev="HIGH") + f"column_name NOT LIKE '%\\_ref' ESCAPE '\\' AND lower(value) IN {_VOCAB_LOW} AND NOT EXISTS (SELECT 1 FROM vocab v WHERE lower(v.term) = lower(value) AND v.column_name = cells.column_name)",
    "q02": _OUT.format(check="misplaced-in-ref", sev="HIGH")
    + "column_name LIKE '%\\_ref' ESCAPE '\\' AND EXISTS (SELECT 1 FROM (SELECT unnest(string_split(value, ', ')) AS p) WHERE "
    + f"{S('p')} <> '' AND NOT regexp_matches(p, '(?i)https?://') AND (lower({S('p')}) IN {_VOCAB_LOW} OR (regexp_full_match({S('p')}, '\\d{{4}}') AND try_cast({S('p')} AS INT) BETWEEN 1900 AND 2100) OR {IS_DATE.format(v=S('p'))} OR regexp_full_match({S('p')}, '[\\d,]{{3,}}')))",
    "q03": _OUT.format(check="url-in-value", sev="HIGH") + "column_name NOT LIKE '%\\_ref' ESCAPE '\\' AND regexp_matches(value, '(?i)https?://')",
    "q04": _OUT.format(check="bad-shape", sev="HIGH") + f"((column_name = 'yard_location_latitude' AND NOT coalesce({NUM('value')} BETWEEN -90 AND 90, false)) OR (column_name = 'yard_location_longitude' AND NOT coalesce({NUM('value')} BETWEEN -180 AND 180, false)))",
    "q05": _OUT.format(check="bad-shape", sev="MED") + f"column_name IN ('capacity', 'imo_number') AND ({NUM('value')}) IS NULL",
    "q06": _OUT.format(check="bad-shape", sev="MED") + r"column_name = 'delivery_year' AND NOT (regexp_full_match(value, '\d{4}(\s*[-/]\s*\d{4})?') AND len([y FOR y IN regexp_extract_all(value, '\d{4}') IF CAST(y AS INT) NOT BETWEEN 1900 AND 2100]) = 0)",
    "q07": _OUT.format(check="bad-shape", sev="MED") + f"column_name = 'contract_date' AND NOT ({IS_DATE.format(v='value')} OR " + " OR ".join(f"regexp_matches(value, '{p}')" for p in quality.OTHER_DATES) + ")",
    "q08": _OUT.format(check="bad-shape", sev="MED") + "column_name IN ('capacity_units', 'price_currency') AND NOT EXISTS (SELECT 1 FROM vocab v WHERE v.term = value AND v.column_name = cells.column_name)",
}


@query(f"{INTAKE_CELLS} {_Q['q01']}")
def q01_misplaced_vocab(spark, sf):
    return _cells(spark, sf, "misplaced-vocab")


@query(f"{INTAKE_CELLS} {_Q['q02']}")
def q02_misplaced_in_ref(spark, sf):
    return _cells(spark, sf, "misplaced-in-ref")


@query(f"{INTAKE_CELLS} {_Q['q03']}")
def q03_url_in_value(spark, sf):
    return _cells(spark, sf, "url-in-value")


@query(f"{INTAKE_CELLS} {_Q['q04']}")
def q04_bad_coordinates(spark, sf):
    return _cells(spark, sf, "bad-shape", ["yard_location_latitude", "yard_location_longitude"])


@query(f"{INTAKE_CELLS} {_Q['q05']}")
def q05_bad_numbers(spark, sf):
    return _cells(spark, sf, "bad-shape", ["capacity", "imo_number"])


@query(f"{INTAKE_CELLS} {_Q['q06']}")
def q06_bad_year(spark, sf):
    return _cells(spark, sf, "bad-shape", ["delivery_year"])


@query(f"{INTAKE_CELLS} {_Q['q07']}")
def q07_bad_date(spark, sf):
    return _cells(spark, sf, "bad-shape", ["contract_date"])


@query(f"{INTAKE_CELLS} {_Q['q08']}")
def q08_off_vocab(spark, sf):
    return _cells(spark, sf, "bad-shape", ["capacity_units", "price_currency"])


_Q["q09"] = " UNION ALL ".join(
    f"SELECT record_id, row_id, '{ref}' AS column_name, {S(ref)} AS value, 'orphan-ref' AS check_name, 'MED' AS severity FROM apply_rows WHERE {S(ref)} <> '' AND " + " AND ".join(f"{S(b)} = ''" for b in base)
    for ref, base in [*[(r, [v]) for v, r in REF_OF.items()], ("yard_location_lat_lon_ref", COORDINATES)]
)
_Q["q10"] = " UNION ALL ".join(f"SELECT record_id, row_id, '{u}' AS column_name, '' AS value, 'missing-pair' AS check_name, 'LOW' AS severity FROM apply_rows WHERE {S(q)} <> '' AND {S(u)} = ''" for q, u in (("capacity", "capacity_units"), ("price", "price_currency")))


@query(_Q["q09"])
def q09_orphan_ref(spark, sf):
    return quality.pair_findings(rows_of(spark, sf)).where("check_name = 'orphan-ref'")


@query(INTAKE + _Q["q10"].replace("apply_rows", "intake"))
def q10_missing_pair(spark, sf):
    return quality.pair_findings(intake(spark, sf).select("record_id", "row_id", "capacity", "capacity_units", "price", "price_currency")).where("check_name = 'missing-pair'")


_PLACE = {"owner": ("shipowner_country_area", "shipowner_facts"), "builder": ("shipbuilder_yard_country_area", "shipbuilder_facts")}
_Q["q11"] = " UNION ALL ".join(
    f"SELECT record_id, row_id, '{c}' AS column_name, {S('s.' + c)} AS value, 'lookup-mismatch' AS check_name, 'MED' AS severity FROM sheet s JOIN {t} f ON s.{k}_tag = f.{k}_tag WHERE {S('s.' + c)} <> '' AND {S('f.' + c)} NOT IN ('', 'AMBIGUOUS') AND {S('s.' + c)} <> {S('f.' + c)}"
    for k, (c, t) in _PLACE.items()
)


def _facts(spark, sf, kind: str) -> DataFrame:
    column, name = _PLACE[kind]
    return lookup.facts_table(table(spark, sf, name).select(F.col(f"{kind}_tag").alias("tag"), F.col(column).alias("value")), "tag")


def _mismatches(spark, sf, sheet: DataFrame) -> DataFrame:
    made = [quality.lookup_mismatch(sheet, f"{k}_tag", _facts(spark, sf, k), c) for k, (c, _) in _PLACE.items()]
    return made[0].unionByName(made[1])


@query(f"WITH {TAGGED} {_Q['q11']}")
def q11_lookup_mismatch(spark, sf):
    return _mismatches(spark, sf, tagged(spark, sf, "record_id", "row_id", *[c for c, _ in _PLACE.values()]))


@query(f"WITH {TAGGED} SELECT DISTINCT 'owner' AS kind, owner_tag AS tag FROM sheet WHERE owner_tag <> '' AND owner_tag NOT IN (SELECT owner_tag FROM shipowner_facts) UNION ALL SELECT DISTINCT 'builder', builder_tag FROM sheet WHERE builder_tag <> '' AND builder_tag NOT IN (SELECT builder_tag FROM shipbuilder_facts)")
def q12_coverage(spark, sf):
    sheet = tagged(spark, sf, "record_id")
    made = [quality.coverage_gap(sheet, f"{k}_tag", _facts(spark, sf, k), k) for k in _PLACE]
    return made[0].unionByName(made[1])


_ALL = " UNION ALL ".join(f"({_Q[q]})" for q in sorted(_Q))
_FOUND = f"{CELLS}, {TAGGED}, found AS ({_ALL})"


def _findings(spark, sf) -> DataFrame:
    sheet = rows_of(spark, sf)
    made = quality.cell_findings(sheet, _rules(spark, sf)).unionByName(quality.pair_findings(sheet))
    return made.unionByName(_mismatches(spark, sf, tagged(spark, sf, "record_id", "row_id", *[c for c, _ in _PLACE.values()])))


@query(f"WITH {_FOUND} SELECT record_id, row_id, '' AS column_name, '' AS value, 'column-offset' AS check_name, 'HIGH' AS severity FROM found GROUP BY record_id, row_id HAVING count(DISTINCT column_name) >= 3")
def q13_column_offset(spark, sf):
    return quality.column_offset(_findings(spark, sf))


_PH = f"ph AS (SELECT record_id, row_id, {S('vessel_name')} AS value, {LABEL} AS label, {INNER} AS tail, builder_tag AS tag, {S('shipowner')} AS owner FROM sheet WHERE {PARTS})"
_DRIFT = (
    "labels AS (SELECT DISTINCT tag, label FROM ph WHERE tag <> '') SELECT p.record_id, p.row_id, 'vessel_name' AS column_name, value, 'name-builder-drift' AS check_name, 'LOW' AS severity, string_agg(l.label, '; ' ORDER BY l.label) AS detail"
    " FROM ph p JOIN labels l ON p.tag = l.tag AND p.label <> l.label GROUP BY p.record_id, p.row_id, value"
)


@query(f"WITH {TAGGED}, {_PH}, {_DRIFT}")
def q14_label_drift(spark, sf):
    return quality.name_findings(tagged(spark, sf, "record_id", "row_id", "vessel_name"), "builder_tag").where("check_name = 'name-builder-drift'")


_GAP = (
    "c AS (SELECT tag, owner FROM ph GROUP BY ALL HAVING count(*) > 1 AND bool_or(regexp_matches(tail, '\\d\\s*$'))) SELECT record_id, row_id, 'vessel_name' AS column_name, value, 'name-ordinal-gap' AS check_name, 'LOW' AS severity, tail AS detail FROM ph"
    f" WHERE (tag, owner) IN (SELECT (tag, owner) FROM c) AND NOT regexp_matches(tail, '\\d\\s*$') AND lower(tail) NOT IN {_IN(quality.DESCRIPTOR_TAILS)}"
)


@query(f"WITH {TAGGED}, {_PH}, {_GAP}")
def q15_ordinal_gap(spark, sf):
    return quality.name_findings(tagged(spark, sf, "record_id", "row_id", "vessel_name"), "builder_tag").where("check_name = 'name-ordinal-gap'")


@query(f"WITH {_FOUND} SELECT record_id, row_id, column_name, value, check_name, severity FROM found WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE {S('d.row_id')} = {S('found.row_id')} AND d.column_name = found.column_name AND d.decision = 'reject')")
def q16_allowlisted(spark, sf):
    allowed = table(spark, sf, "decisions").where("decision = 'reject'").select("row_id", "column_name")
    return quality.without_allowed(_findings(spark, sf), allowed)


@query(f"WITH {_FOUND} SELECT check_name, severity, count(*) AS findings, count(DISTINCT record_id) AS records FROM found GROUP BY ALL")
def q17_summary(spark, sf):
    return quality.summary(_findings(spark, sf))


@query(f"WITH {_FOUND} SELECT record_id, row_id, column_name, substr(value, 1, 120) AS value, check_name, severity FROM found")
def k01_quality_report(spark, sf):
    from fairlead.sources.sinks import shortened

    return shortened(_findings(spark, sf), {"value": 120})


_LAST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {{key}} ORDER BY {{by}}) AS k FROM apply_rows WHERE {S('row_id')} <> '') WHERE k = 1"
_KEYED = f"latest AS ({_LAST.format(key='row_id', by='loaded_at DESC, record_id DESC')}), byrow AS (SELECT try_cast(row_id AS BIGINT) AS key, * FROM latest)"
_ACC = f"acc AS (SELECT cell_id, {_WHOLE.format(c='row_id')} AS key, column_name, accepted_value AS value, confidence FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY loaded_at DESC, accepted_value DESC) AS k FROM apply_accepted) WHERE k = 1)"
_CELL = "CASE column_name " + " ".join(f"WHEN '{c}' THEN {S('s.' + c)}" for c in SHEET_COLUMNS) + " END"


def by_key(spark, sf) -> DataFrame:
    """The latest row of each row id, with key, the number that the id stands for."""
    return quality.latest_rows(rows_of(spark, sf)).withColumn("key", whole_number(F.col("row_id")))


def accepted(spark, sf) -> DataFrame:
    """The latest delivery of each accepted cell."""
    raw = table(spark, sf, "apply_accepted")
    last = raw.groupBy("cell_id").agg(F.max(F.struct("loaded_at", "accepted_value", "row_id", "column_name", "confidence", "cluster_id")).alias("m"))
    return last.select("cell_id", whole_number(F.col("m.row_id")).alias("key"), F.col("m.column_name").alias("column_name"), F.col("m.accepted_value").alias("value"), F.col("m.confidence").alias("confidence"), F.col("m.cluster_id").alias("cluster_id"))


_PAIR = " UNION ALL ".join(
    f"SELECT cell_id, column_name, 'missing-pair' AS check_name FROM f WHERE column_name = '{q}' AND v <> '' AND unit_{q} = ''" for q in ("capacity", "price")
)


@query(
    f"WITH {_KEYED}, {_ACC}, f AS (SELECT cell_id, acc.column_name, {S('acc.value')} AS v, {S('s.capacity_units')} AS unit_capacity, {S('s.price_currency')} AS unit_price FROM acc JOIN byrow s ON acc.key = s.key) {_PAIR}"
    " UNION ALL SELECT cell_id, column_name, 'off-vocab' FROM f WHERE v <> '' AND column_name IN (SELECT column_name FROM vocab) AND NOT EXISTS (SELECT 1 FROM vocab t WHERE t.column_name = f.column_name AND t.term = f.v)"
)
def q18_fill_consistency(spark, sf):
    own = patch.skew_join(accepted(spark, sf).select("cell_id", "key", "column_name", X.strip(F.col("value")).alias("v")), by_key(spark, sf).select("key", "capacity_units", "price_currency"), "key").where("v <> ''")
    terms = quality.vocabulary(table(spark, sf, "vocab"))
    off = F.lit(False)
    for c, ts in terms.items():
        off = off | ((F.col("column_name") == c) & ~F.col("v").isin(sorted(ts)))
    bare = lambda q, u: (F.col("column_name") == q) & (X.strip(F.col(u)) == "")
    checks = F.array(F.when(bare("capacity", "capacity_units") | bare("price", "price_currency"), F.lit("missing-pair")), F.when(off, F.lit("off-vocab")))
    return own.select("cell_id", "column_name", F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("check_name"))


# ---- lookups and derivation ---------------------------------------------------------------------------------------


@query(
    f"WITH {TAGGED}, v AS (SELECT owner_tag AS tag, nullif({S('shipowner_country_area')}, '') AS v, nullif({S('shipowner_country_area_ref')}, '') AS r, record_id FROM sheet WHERE owner_tag <> '') "
    "SELECT tag, CASE WHEN min(v) = max(v) THEN min(v) ELSE 'AMBIGUOUS' END AS value, CASE WHEN min(v) = max(v) THEN coalesce(arg_min(r, record_id) FILTER (WHERE r IS NOT NULL), '') ELSE '' END AS ref, count(*) AS seen FROM v GROUP BY tag HAVING min(v) IS NOT NULL"
)
def a04_owner_facts(spark, sf):
    sheet = tagged(spark, sf, "record_id", "shipowner_country_area", "shipowner_country_area_ref")
    return lookup.derive_unambiguous(sheet, "owner_tag", "shipowner_country_area", "shipowner_country_area_ref", "record_id")


_BLOCK = ", ".join(f"{S(c)} AS {c}" for c in YARD_BLOCK)
_FILLED = " + ".join(f"CASE WHEN {c} <> '' THEN 1 ELSE 0 END" for c in YARD_BLOCK)
_FULLEST = f"blocks AS (SELECT builder_tag AS tag, record_id, {_BLOCK} FROM sheet WHERE builder_tag <> ''), ranked AS (SELECT *, {_FILLED} AS filled, row_number() OVER (PARTITION BY tag ORDER BY {_FILLED} DESC, record_id) AS k FROM blocks), best AS (SELECT * FROM ranked WHERE k = 1 AND filled > 0)"


def _yards(spark, sf) -> DataFrame:
    return lookup.fullest_block(tagged(spark, sf, "record_id", *YARD_BLOCK), "builder_tag", YARD_BLOCK, "record_id")


@query(f"WITH {TAGGED}, {_FULLEST} SELECT tag, filled, {', '.join(YARD_BLOCK)} FROM best")
def a05_yard_block(spark, sf):
    return _yards(spark, sf)


_USABLE = lambda c: f"nullif(nullif({S(c)}, ''), 'AMBIGUOUS')"


@query(f"WITH {TAGGED}, {_FULLEST} SELECT coalesce(f.builder_tag, b.tag) AS tag, " + ", ".join(f"coalesce({_USABLE('f.' + c)}, {_USABLE('b.' + c)}, '') AS {c}" for c in YARD_BLOCK) + " FROM shipbuilder_facts f FULL JOIN best b ON f.builder_tag = b.tag")
def m01_table_first_yards(spark, sf):
    curated = lookup.facts_table(table(spark, sf, "shipbuilder_facts").withColumnRenamed("builder_tag", "tag"), "tag")
    return lookup.table_first(curated, _yards(spark, sf), "tag", YARD_BLOCK)


@query(
    f"WITH {TAGGED}, v AS (SELECT owner_tag AS tag, nullif({S('shipowner_country_area')}, '') AS v FROM sheet WHERE owner_tag <> ''), d AS (SELECT tag, CASE WHEN min(v) = max(v) THEN min(v) ELSE 'AMBIGUOUS' END AS b FROM v GROUP BY tag HAVING min(v) IS NOT NULL), c AS (SELECT owner_tag AS tag, {S('shipowner_country_area')} AS a FROM shipowner_facts) "
    "SELECT coalesce(c.tag, d.tag) AS tag, coalesce(a, b) AS value, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'kept' WHEN a = b THEN 'same' ELSE 'differs' END AS status FROM c FULL JOIN d ON c.tag = d.tag"
)
def m03_merge_facts(spark, sf):
    derived = a04_owner_facts(spark, sf)
    return lookup.merge_facts(_facts(spark, sf, "owner"), derived, "tag", "value")


@query(f"WITH {TAGGED} SELECT record_id, {_USABLE('f.shipowner_country_area')} AS country FROM sheet s LEFT JOIN shipowner_facts f ON s.owner_tag = f.owner_tag")
def j10_facts_lookup(spark, sf):
    known = _facts(spark, sf, "owner").select(F.col("tag").alias("owner_tag"), lookup.usable(F.col("value")).alias("country"))
    return patch.skew_join(tagged(spark, sf, "record_id"), known, "owner_tag", "left").select("record_id", "country")


@query(
    f"WITH {TAGGED}, v AS (SELECT owner_tag AS tag, nullif({S('shipowner_country_area')}, '') AS v, nullif({S('shipowner_country_area_ref')}, '') AS r, record_id FROM sheet WHERE owner_tag NOT IN ('', 'unknown')), d AS (SELECT tag, min(v) AS v, arg_min(r, record_id) FILTER (WHERE r IS NOT NULL AND v IS NOT NULL) AS r FROM v GROUP BY tag HAVING min(v) = max(v)) "
    f"SELECT s.record_id, d.v AS country, coalesce(d.r, '') AS ref FROM sheet s JOIN d ON s.owner_tag = d.tag WHERE {S('s.shipowner_country_area')} = ''"
)
def j16_sibling_country(spark, sf):
    sheet = tagged(spark, sf, "record_id", "shipowner_country_area", "shipowner_country_area_ref")
    given = sheet.where((X.strip(F.col("shipowner_country_area")) != "") & ~F.col("owner_tag").isin("", "unknown"))
    known = lookup.derive_unambiguous(given, "owner_tag", "shipowner_country_area", "shipowner_country_area_ref", "record_id").where(F.col("value") != lookup.AMBIGUOUS)
    own = sheet.where(X.strip(F.col("shipowner_country_area")) == "").select("record_id", F.col("owner_tag").alias("tag"))
    return patch.skew_join(own, known, "tag").select("record_id", F.col("value").alias("country"), "ref")


_DERIVED = " UNION ALL ".join(f"SELECT record_id, '{c}' AS column_name, {_USABLE('f.' + c)} AS value FROM sheet s JOIN shipbuilder_facts f ON s.builder_tag = f.builder_tag WHERE {S('s.' + c)} = '' AND {_USABLE('f.' + c)} IS NOT NULL" for c in YARD_BLOCK)


@query(f"WITH {TAGGED} {_DERIVED}")
def m02_derivable_fills(spark, sf):
    facts = lookup.facts_table(table(spark, sf, "shipbuilder_facts").withColumnRenamed("builder_tag", "tag"), "tag")
    return proposals.derivable_fills(tagged(spark, sf, "record_id", *YARD_BLOCK), "builder_tag", facts, YARD_BLOCK)


RESEARCHED = ["imo_number", "hull_number", "capacity", "cargo_type", "vessel_type", "propulsion_type", "delivery_year", "operator_charterer", "contract_date", "price"]
_GAPS = " UNION ALL ".join(f"SELECT record_id, row_id, '{c}' AS column_name, CASE WHEN {S(c)} = '' THEN 'blank' ELSE 'unknown' END AS state FROM apply_rows WHERE {S(c)} = '' OR lower({S(c)}) = 'unknown'" for c in RESEARCHED)


@query(_GAPS)
def f08_gaps(spark, sf):
    return proposals.gaps(rows_of(spark, sf), RESEARCHED)


@query(f"WITH {TAGGED}, g AS ({_GAPS}) SELECT owner_tag, builder_tag, count(DISTINCT g.record_id) AS rows, count(*) AS cells FROM g JOIN sheet USING (record_id) GROUP BY ALL")
def a10_gap_targets(spark, sf):
    return proposals.gap_targets(proposals.gaps(rows_of(spark, sf), RESEARCHED), tagged(spark, sf, "record_id"), ["owner_tag", "builder_tag"])


_PAIRS = {c: REF_OF[c] for c in ("capacity", "cargo_type", "vessel_type", "propulsion_type", "delivery_year")}


@query(" UNION ALL ".join(f"SELECT record_id, '{v}' AS column_name, {S(v)} AS value FROM apply_rows WHERE {S(v)} <> '' AND lower({S(v)}) <> 'unknown' AND array_to_string({SPLIT_REFS(r)}, chr(10)) = 'inferred'" for v, r in _PAIRS.items()))
def f07_sole_source(spark, sf):
    return proposals.sole_source_cells(rows_of(spark, sf), _PAIRS, "inferred")


@query(f"SELECT record_id, row_id FROM apply_rows WHERE regexp_full_match({S('row_id')}, '\\d{{1,18}}') AND try_cast({S('row_id')} AS BIGINT) BETWEEN 100 AND 400")
def f02_row_range(spark, sf):
    return rows_of(spark, sf).where(proposals.in_rows(F.col("row_id"), *proposals.row_range("400-100"))).select("record_id", "row_id")


@query(f"SELECT record_id FROM apply_rows WHERE coalesce({DATE('last_updated')}, 0) >= 20250601")
def f06_updated_since(spark, sf):
    return rows_of(spark, sf).where(proposals.updated_since(F.col("last_updated"), 20250601)).select("record_id")


@query(" UNION ALL ".join(f"SELECT record_id, '{r}' AS column_name FROM apply_rows WHERE {S(v)} <> '' AND {S(r)} = ''" for v, r in REF_OF.items()))
def f18_fillable_citations(spark, sf):
    made = [F.when((X.strip(F.col(v)) != "") & (X.strip(F.col(r)) == ""), F.lit(r)) for v, r in REF_OF.items()]
    return rows_of(spark, sf).select("record_id", F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("column_name"))


@query(f"SELECT min(try_cast(row_id AS BIGINT)) AS least, max(try_cast(row_id AS BIGINT)) AS most FROM apply_rows WHERE regexp_full_match({S('row_id')}, '\\d+')")
def a16_row_bounds(spark, sf):
    n = X.strip(F.col("row_id")).try_cast("bigint")
    return rows_of(spark, sf).where(X.strip(F.col("row_id")).rlike(r"^\d+$")).agg(F.min(n).alias("least"), F.max(n).alias("most"))


# ---- duplicates ---------------------------------------------------------------------------------------------------

_DUP = (
    f"keyed AS (SELECT record_id, row_id, builder_tag AS builder, owner_tag AS owner, CASE WHEN length(regexp_replace(coalesce(imo_number, ''), '[^0-9]', '', 'g')) >= 6 THEN regexp_replace(imo_number, '[^0-9]', '', 'g') ELSE '' END AS imo, {S(_HULL)} AS hull,"
    f" try_cast(nullif(regexp_replace(coalesce(capacity, ''), '[^0-9]', '', 'g'), '') AS BIGINT) AS size, {BUCKET} AS bucket, regexp_extract(coalesce(delivery_year, ''), '((?:19|20)\\d{{2}})', 1) AS year, {MONTH('contract_date')} AS month, {MARKS} AS marks FROM sheet), k AS (SELECT *, imo = '' AND hull = '' AS slot FROM keyed)"
)
_DUP_COLUMNS = ["record_id", "row_id", "imo_number", "hull_number", "capacity", "delivery_year", "contract_date", "vessel_name", "original_source"]


def _keyed(spark, sf) -> DataFrame:
    return dedupe.keyed_rows(tagged(spark, sf, *_DUP_COLUMNS))


def _index(columns: list[str], kind: str) -> str:
    key = " || '|' || ".join(columns)
    return f"WITH {TAGGED}, {_DUP} SELECT '{kind}' AS kind, {key} AS key, count(*) AS rows, min(record_id) AS first_record, max(record_id) AS last_record FROM k WHERE " + " AND ".join(f"{c} <> ''" for c in columns) + " GROUP BY 1, 2"


@query(_index(["builder", "hull"], "hull"))
def a01_hull_index(spark, sf):
    return dedupe.key_index(_keyed(spark, sf), ["builder", "hull"], "hull")


@query(_index(["builder", "owner", "month"], "order"))
def a02_order_index(spark, sf):
    return dedupe.key_index(_keyed(spark, sf), ["builder", "owner", "month"], "order")


@query(f"WITH {TAGGED}, {_DUP} SELECT count(*) AS rows, count(DISTINCT CASE WHEN builder <> '' AND hull <> '' THEN builder || '|' || hull END) AS hull_keys, count(DISTINCT CASE WHEN builder <> '' AND owner <> '' AND month <> '' THEN builder || '|' || owner || '|' || month END) AS order_keys FROM k")
def a03_index_stats(spark, sf):
    return dedupe.index_stats(_keyed(spark, sf))


def _shared(columns: list[str], kind: str) -> str:
    key, given = " || '|' || ".join(columns), " AND ".join(f"{c} <> ''" for c in columns)
    return f"WITH {TAGGED}, {_DUP} SELECT '{kind}' AS kind, {key} AS key, record_id FROM k WHERE {given} AND {key} IN (SELECT {key} FROM k WHERE {given} GROUP BY 1 HAVING count(DISTINCT row_id) > 1)"


@query(_shared(["imo"], "imo"))
def j06_shared_number(spark, sf):
    return dedupe.shared_key(_keyed(spark, sf), ["imo"], "imo")


@query(_shared(["builder", "hull"], "hull"))
def j07_shared_hull(spark, sf):
    return dedupe.shared_key(_keyed(spark, sf), ["builder", "hull"], "hull")


_MAY = "a.builder = b.builder AND a.owner = b.owner AND a.bucket = b.bucket AND a.bucket > 0 AND a.builder <> '' AND a.owner <> '' AND a.record_id <> b.record_id AND coalesce(abs(a.size - b.size) <= 8000, true) AND NOT (a.year <> '' AND b.year <> '' AND abs(try_cast(a.year AS INT) - try_cast(b.year AS INT)) > 1) AND (a.slot OR b.slot)"
_APART = "len(a.marks) > 0 AND len(b.marks) > 0 AND NOT list_has_any(a.marks, b.marks)"


@query(f"WITH {TAGGED}, {_DUP} SELECT a.record_id, CAST(count(*) FILTER (NOT ({_APART})) AS BIGINT) AS tier2_links, CAST(count(*) FILTER ({_APART}) AS BIGINT) AS tier4_links FROM k a JOIN k b ON {_MAY} GROUP BY a.record_id")
def j08_block_links(spark, sf):
    return dedupe.block_links(_keyed(spark, sf))


@query(f"WITH {TAGGED}, {_DUP} SELECT DISTINCT least(a.record_id, b.record_id) AS record_id_a, greatest(a.record_id, b.record_id) AS record_id_b, CASE WHEN {_APART} THEN 4 ELSE 2 END AS tier FROM k a JOIN k b ON {_MAY} WHERE a.record_id % 50 = 0")
def j08_focus_pairs(spark, sf):
    keyed = _keyed(spark, sf)
    return dedupe.focus_pairs(keyed, keyed.where("record_id % 50 = 0"))


@query(
    f"WITH {TAGGED}, {_DUP}, d AS (SELECT record_id, builder, owner, {DATE('contract_date')} AS i FROM k JOIN (SELECT record_id, contract_date FROM apply_rows) USING (record_id)), "
    "e AS (SELECT record_id, builder, owner, try_strptime(CAST(i AS VARCHAR), '%Y%m%d')::DATE AS day FROM d WHERE i IS NOT NULL), g AS (SELECT *, CASE WHEN day - lag(day) OVER w <= 30 THEN 0 ELSE 1 END AS n FROM e WHERE day IS NOT NULL AND builder <> '' AND owner <> '' WINDOW w AS (PARTITION BY builder, owner ORDER BY day, record_id)) "
    "SELECT record_id, CAST(sum(n) OVER (PARTITION BY builder, owner ORDER BY day, record_id) AS INT) AS run FROM g"
)
def j22_order_runs(spark, sf):
    sheet = tagged(spark, sf, "record_id", "contract_date").withColumn("day", F.try_to_date(P.date_int(F.col("contract_date")).cast("string"), "yyyyMMdd"))
    own = sheet.where("day is not null and owner_tag <> '' and builder_tag <> ''")
    return quality.labelled_runs(own.select("record_id", "day", "owner_tag", "builder_tag"), ["builder_tag", "owner_tag"], "day", "record_id").select("record_id", "run")


# ---- reconciliation -----------------------------------------------------------------------------------------------


def _roster(spark, sf) -> DataFrame:
    f = table(spark, sf, "giignl_fsru_fleet")
    tags = lookup.lessor_tags(F.col("vessel_owner"), owner_aliases(spark, sf))
    return f.select(F.col("fleet_id").alias("idx"), "vessel_name", "ex_names", F.col("storage_m3").alias("size"), F.col("built_year").alias("year"), tags.alias("tags"), F.col("ccs").alias("grade"), "builder", "vessel_owner")


def _reconciled(spark, sf) -> DataFrame:
    tags = lookup.lessor_tags(F.col("shipowner"), owner_aliases(spark, sf))
    return rows_of(spark, sf).where(X.strip(F.col("vessel_name")) != "").select(F.col("record_id").alias("pos"), F.col("vessel_name").alias("name"), P.whole(F.col("capacity")).alias("size"), P.whole(F.col("delivery_year")).cast("int").alias("year"), tags.alias("tags"), X.strip(F.col("vessel_type")).alias("vessel_type"), "shipbuilder")


_INT = lambda c: rf"CASE WHEN regexp_full_match(replace({S(c)}, ',', ''), '[+-]?\d{{1,18}}') THEN try_cast(replace({S(c)}, ',', '') AS BIGINT) END"
_NAMED = (
    f"back AS (SELECT record_id AS pos, {VESSEL_KEY('vessel_name')} AS key, {_INT('capacity')} AS size, {S('vessel_type')} AS vessel_type FROM apply_rows WHERE {S('vessel_name')} <> ''), "
    f"fk AS (SELECT DISTINCT fleet_id AS idx, storage_m3 AS s, {VESSEL_KEY('n')} AS key FROM (SELECT fleet_id, storage_m3, unnest([vessel_name] || coalesce(ex_names, [])) AS n FROM giignl_fsru_fleet)), "
    "hits AS (SELECT DISTINCT idx, pos, vessel_type, coalesce(CAST(abs(s - size) AS DOUBLE), 'Infinity'::DOUBLE) AS distance FROM fk JOIN back USING (key) WHERE key <> ''), "
    "named AS (SELECT idx, pos, vessel_type, distance FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY vessel_type <> 'FSRU', distance, pos) AS k FROM hits) WHERE k = 1)"
)


@query(f"WITH {_NAMED} SELECT idx, pos, vessel_type, CASE WHEN isinf(distance) THEN -1 ELSE distance END AS distance FROM named")
def j02_name_join(spark, sf):
    found = reconcile.name_join(_roster(spark, sf), _reconciled(spark, sf))
    return found.withColumn("distance", F.when(F.col("distance") == float("inf"), -1.0).otherwise(F.col("distance")))


@query(f"WITH {_NAMED} SELECT pos FROM back WHERE vessel_type = 'FSRU' AND pos NOT IN (SELECT pos FROM named)")
def j05_sheet_only(spark, sf):
    sheet = _reconciled(spark, sf)
    return sheet.where("vessel_type = 'FSRU'").join(reconcile.name_join(_roster(spark, sf), sheet).select("pos"), "pos", "left_anti").select("pos")


@query(None)
def m12_buckets(spark, sf):
    return reconcile.buckets(_roster(spark, sf), _reconciled(spark, sf))


@query(None)
def a08_bucket_counts(spark, sf):
    return m12_buckets(spark, sf).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("small")).alias("small"))


@query(
    f"WITH {_NAMED} SELECT n.idx, n.pos, CASE WHEN s IS NOT NULL AND size IS NOT NULL THEN abs(s - size) <= greatest(6000.0, 0.03 * greatest(s, size)) END AS size_agrees,"
    " CASE WHEN coalesce(built_year, 0) <> 0 AND coalesce(y, 0) <> 0 THEN built_year = y END AS year_same FROM named n JOIN (SELECT fleet_id AS idx, storage_m3 AS s, built_year FROM giignl_fsru_fleet) f USING (idx)"
    f" JOIN (SELECT record_id AS pos, {_INT('capacity')} AS size, {_INT('delivery_year')} AS y FROM apply_rows) a USING (pos)"
)
def m11_pair_differences(spark, sf):
    roster, sheet = _roster(spark, sf), _reconciled(spark, sf)
    l = roster.select("idx", F.col("size").alias("l_size"), F.col("year").alias("l_year"), F.col("tags").alias("l_tags"), F.col("builder").alias("l_builder"))
    r = sheet.select("pos", F.col("size").alias("r_size"), F.col("year").alias("r_year"), F.col("tags").alias("r_tags"), F.col("shipbuilder").alias("r_builder"))
    pairs = reconcile.name_join(roster, sheet).select("idx", "pos").join(l, "idx").join(r, "pos")
    return reconcile.pair_differences(pairs).select("idx", "pos", "size_agrees", "year_same")


def _sides(spark, sf):
    """The row numbers of the report, of the sheet, and of rejected decisions, as text."""
    key = lambda df: df.select(F.coalesce(whole_number(F.col("row_id")).cast("string"), F.lit("")).alias("row"))
    return key(table(spark, sf, "verify_report")), key(rows_of(spark, sf)), key(table(spark, sf, "decisions").where("decision = 'reject'"))


def _key_side(t: str) -> str:
    return "SELECT coalesce(CAST(" + _WHOLE.format(c="row_id") + f" AS VARCHAR), '') AS key, count(*) AS n FROM {t} GROUP BY 1"



@query(
    f"WITH l AS ({_key_side('verify_report')}), r AS ({_key_side('apply_rows')}), x AS ({_key_side("(SELECT * FROM decisions WHERE decision = 'reject')")}), b AS (SELECT coalesce(l.key, r.key) AS key, l.n AS ln, r.n AS rn, x.n IS NOT NULL AS x FROM (SELECT * FROM l WHERE key <> '') l FULL JOIN (SELECT * FROM r WHERE key <> '') r ON l.key = r.key LEFT JOIN x ON x.key = coalesce(l.key, r.key)) "
    "SELECT CASE WHEN ln IS NOT NULL AND rn IS NOT NULL THEN CASE WHEN x THEN 'contradiction' ELSE 'matched' END WHEN ln IS NOT NULL THEN CASE WHEN x THEN 'only_left_excluded' ELSE 'only_left' END ELSE 'only_right' END AS bucket,"
    " CASE WHEN ln IS NOT NULL AND rn IS NOT NULL THEN 'both' WHEN ln IS NOT NULL THEN 'left' ELSE 'right' END AS side, key, coalesce(ln, 0) + coalesce(rn, 0) AS rows FROM b"
    " UNION ALL SELECT 'null_key', 'left', key, n FROM l WHERE key = '' UNION ALL SELECT 'null_key', 'right', key, n FROM r WHERE key = ''"
)
def j13_key_buckets(spark, sf):
    return reconcile.key_buckets(*_sides(spark, sf), "row")


_FIELDS = ["accepted_value", "backend_value", "status"]


@query(
    "WITH " + ", ".join(f"{s} AS (SELECT check_id, " + ", ".join(f"arg_max({S(c)}, loaded_at) AS {c}" for c in _FIELDS) + f" FROM {t} GROUP BY check_id)" for s, t in (("a", "verify_report"), ("b", "verify_rerun")))
    + ", d AS (SELECT check_id, [x FOR x IN [" + ", ".join(f"CASE WHEN a.{c} <> b.{c} THEN '{c}: ' || a.{c} || ' | ' || b.{c} END" for c in _FIELDS) + "] IF x IS NOT NULL] AS l FROM a JOIN b USING (check_id)) SELECT check_id, CAST(len(l) AS INT) AS n, array_to_string(l, '; ') AS differences FROM d WHERE len(l) > 0"
)
def j14_field_differences(spark, sf):
    side = lambda t, s: table(spark, sf, t).groupBy("check_id").agg(F.max(F.struct("loaded_at", *_FIELDS)).alias("m")).select("check_id", *[F.col(f"m.{c}").alias(f"{s}_{c}") for c in _FIELDS])
    pairs = side("verify_report", "l").join(side("verify_rerun", "r"), "check_id")
    return reconcile.field_differences(pairs, "check_id", [f"l_{c}" for c in _FIELDS], [f"r_{c}" for c in _FIELDS], _FIELDS)


# ---- decisions, patches, verification -----------------------------------------------------------------------------

_DEC = "last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY loaded_at DESC, item_id DESC) AS k FROM decisions) WHERE k = 1)"


def _decisions(spark, sf) -> DataFrame:
    raw = table(spark, sf, "decisions")
    rest = ["item_id", "batch", "kind", "row_id", "column_name", "confidence", "derivable", "default_decision", "decision", "proposed_value", "decided_at"]
    return proposals.first_wins(raw.select("decision_id", (-F.unix_micros(F.col("loaded_at").cast("timestamp"))).alias("_o"), F.col("item_id"), *rest[1:]), ["decision_id"], ["_o"]).drop("_o")


_EFFECTIVE = f"lower(coalesce(nullif({S('decision')}, ''), {S('default_decision')}))"


@query(f"WITH {_DEC} SELECT decision_id, {_EFFECTIVE} AS effective FROM last")
def m05_effective_decisions(spark, sf):
    d = _decisions(spark, sf)
    items = d.select(F.col("decision_id").alias("item_id"), "default_decision")
    return proposals.overlay_decisions(items, d.select(F.col("decision_id").alias("item_id"), "decision")).select(F.col("item_id").alias("decision_id"), "effective")


@query(f"WITH {_DEC} SELECT batch, {_EFFECTIVE} AS effective, count(*) AS n FROM last GROUP BY ALL")
def a09_decision_counts(spark, sf):
    d = _decisions(spark, sf).select("decision_id", "batch", F.lower(F.coalesce(F.when(X.strip(F.col("decision")) != "", X.strip(F.col("decision"))), X.strip(F.col("default_decision")))).alias("effective"))
    return d.groupBy("batch", "effective").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_DEC}, f AS (SELECT {_WHOLE.format(c='row_id')} AS key, column_name, decision_id, proposed_value FROM last) SELECT key, column_name, decision_id, proposed_value FROM (SELECT *, row_number() OVER (PARTITION BY key, column_name ORDER BY decision_id) AS k FROM f WHERE key IS NOT NULL AND column_name IS NOT NULL) WHERE k = 1")
def o04_first_wins(spark, sf):
    f = _decisions(spark, sf).select(whole_number(F.col("row_id")).alias("key"), "column_name", "decision_id", "proposed_value").where("key is not null and column_name is not null")
    return proposals.first_wins(f, ["key", "column_name"], ["decision_id"])


@query("SELECT column_name AS label, count(*) AS n, max(CASE confidence WHEN 'G' THEN 3 WHEN 'Y' THEN 2 WHEN 'R' THEN 1 ELSE 0 END) AS best FROM decisions WHERE column_name IS NOT NULL GROUP BY 1")
def a12_field_counts(spark, sf):
    rank = F.when(F.col("confidence") == "G", 3).when(F.col("confidence") == "Y", 2).when(F.col("confidence") == "R", 1).otherwise(0)
    return table(spark, sf, "decisions").where("column_name is not null").groupBy(F.col("column_name").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("best"))


@query(
    f"WITH {_KEYED}, {_ACC}, j AS (SELECT cell_id, column_name, {SQ('acc.value')} AS value, {SQ(_CELL)} AS found FROM acc LEFT JOIN byrow s ON acc.key = s.key WHERE column_name IS NOT NULL) SELECT *, CASE WHEN found = '' THEN 'MISSING' WHEN found = value THEN 'landed' ELSE 'MISMATCH' END AS status FROM j"
)
def j12_verify_cells(spark, sf):
    return patch.verify_cells(accepted(spark, sf).where("column_name is not null"), by_key(spark, sf).select("key", *SHEET_COLUMNS), SHEET_COLUMNS)


@query(
    f"WITH p AS (SELECT fleet_id AS new_id, {SQ('vessel_name')} AS name FROM giignl_fsru_fleet), s AS (SELECT min(record_id) AS record_id, {SQ('vessel_name')} AS name FROM apply_rows GROUP BY 2) SELECT new_id, record_id AS present_in, record_id IS NOT NULL OR p.name = '' AS present FROM p LEFT JOIN s ON p.name = s.name AND p.name <> ''"
)
def j11_rows_present(spark, sf):
    new = table(spark, sf, "giignl_fsru_fleet").select(F.col("fleet_id").alias("new_id"), F.col("vessel_name").alias("name"), F.lit("").alias("hull"))
    sheet = rows_of(spark, sf).select("record_id", F.col("vessel_name").alias("name"), F.col("hull_number").alias("hull"))
    return patch.rows_present(new, sheet)


_STATUS = f"CASE WHEN s.key IS NULL THEN 'no-row' WHEN column_name NOT IN {_IN(SHEET_COLUMNS)} THEN 'no-column' WHEN old = v THEN 'same' WHEN old <> '' THEN 'kept' ELSE 'written' END"


@query(
    f"WITH {_KEYED}, {_ACC}, j AS (SELECT cell_id AS patch_id, acc.key, acc.column_name, {S('acc.value')} AS v, {_CELL} AS old, s.key AS sk FROM acc LEFT JOIN byrow s ON acc.key = s.key WHERE acc.key IS NOT NULL AND column_name IS NOT NULL) SELECT patch_id, key, column_name, v AS value, old, {_STATUS.replace('s.key', 'sk')} AS status FROM j"
)
def m07_patch_set(spark, sf):
    own = accepted(spark, sf).where("key is not null and column_name is not null").withColumnRenamed("cell_id", "patch_id")
    return patch.apply_set(own, by_key(spark, sf).select("key", *SHEET_COLUMNS), SHEET_COLUMNS)


APPENDED = ["vessel_name", "hull_number", "shipowner", "shipbuilder", "capacity", "cargo_type", "vessel_type", "delivery_year"]


@query(f"WITH {_ACC} SELECT key, " + ", ".join(f"coalesce(arg_max(value, cell_id) FILTER (WHERE column_name = '{c}'), '') AS {c}" for c in APPENDED) + f" FROM acc WHERE key IS NOT NULL AND column_name IN {_IN(APPENDED)} GROUP BY key")
def m08_append_pivot(spark, sf):
    own = accepted(spark, sf).where("key is not null").withColumnRenamed("cell_id", "patch_id")
    return patch.appended_rows(own, APPENDED)


@query(
    f"WITH {_KEYED}, {_ACC}, p AS (SELECT key, column_name, arg_max(value, cell_id) AS value FROM acc WHERE key IS NOT NULL AND column_name IN {_IN(APPENDED)} AND value IS NOT NULL GROUP BY ALL), w AS (SELECT key, "
    + ", ".join(f"max(CASE WHEN column_name = '{c}' THEN value END) AS {c}" for c in APPENDED)
    + " FROM p GROUP BY key) SELECT w.key, " + ", ".join(f"coalesce(w.{c}, {S('s.' + c)}) AS {c}" for c in APPENDED) + " FROM w JOIN byrow s ON w.key = s.key"
)
def m06_touched_rows(spark, sf):
    own = accepted(spark, sf).where("key is not null and value is not null").withColumnRenamed("cell_id", "patch_id")
    return patch.patched_rows(by_key(spark, sf).select("key", *APPENDED), own, APPENDED)


@query(f"SELECT {S('confidence')} AS confidence, batch, count(*) AS cells, count(DISTINCT cell_id) AS distinct_cells FROM apply_accepted GROUP BY ALL")
def k07_accepted_counts(spark, sf):
    return table(spark, sf, "apply_accepted").groupBy(X.strip(F.col("confidence")).alias("confidence"), "batch").agg(F.count(F.lit(1)).alias("cells"), F.count_distinct("cell_id").alias("distinct_cells"))


# ---- gate ---------------------------------------------------------------------------------------------------------

_PAGE_URL = "concat('https://pages.example/', CAST(doc_id AS STRING))"


def _pages(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    title = F.when(F.expr("doc_id % 13 = 0"), "Page not found").otherwise(F.col("source"))
    return d.select(F.expr(_PAGE_URL).alias("url"), F.when(F.expr("doc_id % 11 = 0"), "404").otherwise("200").alias("status"), F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body>"), F.col("text"), F.lit("</body></html>")).alias("html"))


def page_url(spark, sf, number: Column) -> Column:
    """Url of the page that a number picks, of all that there are."""
    n = table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()
    return F.concat(F.lit("https://pages.example/"), (number % n + 1).cast("string"))


_PAGES = "(SELECT count(*) FROM documents)"


def _claims(spark, sf) -> DataFrame:
    """One claim per accepted cell about a page that its number picks: owners, sizes and years, which pages do hold at times."""
    return accepted(spark, sf).select(F.col("cell_id").alias("claim"), page_url(spark, sf, F.col("cell_id")).alias("url"), "value")


@query(
    f"WITH {_ACC}, p AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '404' ELSE '200' END AS status, CASE WHEN doc_id % 13 = 0 THEN 'page not found' ELSE lower(source) END AS title, lower('<html><head><title>' || CASE WHEN doc_id % 13 = 0 THEN 'Page not found' ELSE source END || '</title></head><body>' || text || '</body></html>') AS html FROM documents), "
    f"j AS (SELECT cell_id AS claim, 'https://pages.example/' || CAST(cell_id % {_PAGES} + 1 AS VARCHAR) AS url, lower(coalesce(value, '')) AS v, p.* FROM acc LEFT JOIN p ON cell_id % {_PAGES} + 1 = doc_id) "
    "SELECT claim, url, coalesce(status = '200' AND doc_id % 13 <> 0 AND contains(html, v), false) AS ok, CASE WHEN doc_id IS NULL THEN 'HTTP 000' WHEN status <> '200' THEN 'HTTP ' || status WHEN doc_id % 13 = 0 THEN 'soft error: not found' WHEN contains(html, v) THEN 'ok' ELSE 'missing: ' || v END AS reason FROM j"
)
def g01_verify(spark, sf):
    claims = _claims(spark, sf).select("claim", "url", F.array(F.lower(F.coalesce("value", F.lit("")))).alias("expected"))
    from fairlead.operators.gate import verify

    return verify(claims, _pages(spark, sf))


def corroborated(asked: str, keys: str) -> str:
    """CTEs up to seen(keys, number, v, reason) of ``asked``, a select of keys, number (of the page) and v."""
    page = (
        "page AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'HTTP 404' WHEN doc_id % 13 = 0 THEN 'soft error: not found' END AS fault,"
        " lower('<html><head><title>' || CASE WHEN doc_id % 13 = 0 THEN 'Page not found' ELSE source END || '</title></head><body>' || text || '</body></html>') AS html FROM documents)"
    )
    words = "[x FOR x IN regexp_extract_all(lower(v), '[a-z0-9]+') IF len(x) >= 3]"
    return (
        f"{_ACC}, {variants_of(asked, keys + ', number')}, {page}, met AS (SELECT var.*, {words} AS words, doc_id, fault, html FROM var LEFT JOIN page ON number = doc_id), "
        f"seen AS (SELECT {keys}, number, v, CASE WHEN v = '' THEN 'no value' WHEN doc_id IS NULL THEN 'HTTP 000' WHEN fault IS NOT NULL THEN fault WHEN len([x FOR x IN l IF contains(html, lower(x))]) > 0 THEN 'ok'"
        r" WHEN NOT regexp_matches(v, '^\$?\s*[\d,]') AND len(words) >= 2 AND len([x FOR x IN words IF NOT contains(html, x)]) = 0 THEN 'ok: all words' ELSE 'value not on page' END AS reason FROM met)"
    )


_OK = "reason IN ('no value', 'ok', 'ok: all words')"
_URL = "'https://pages.example/' || CAST(number AS VARCHAR)"


@query("WITH " + corroborated(f"SELECT cell_id, cell_id % {_PAGES} + 1 AS number, {S('value')} AS v FROM acc", "cell_id") + f" SELECT cell_id AS claim, {_URL} AS url, {_OK} AS ok, reason FROM seen")
def g02_corroborate(spark, sf):
    from fairlead.operators.gate import corroborate

    return corroborate(_claims(spark, sf), _pages(spark, sf))


@query(
    "WITH " + corroborated(f"SELECT cell_id, pos, (cell_id + pos) % {_PAGES} + 1 AS number, {S('value')} AS v FROM acc, (SELECT unnest([0, 7, 13]) AS pos)", "cell_id, pos")
    + f", per AS (SELECT cell_id, count(*) FILTER (WHERE NOT {_OK} AND regexp_matches(reason, '^(HTTP|soft error)')) AS dead, count(*) FILTER (WHERE reason = 'value not on page') AS conflicts, list_distinct(list({_URL}) FILTER (WHERE {_OK})) AS kept, coalesce(string_agg({_URL}, ', ' ORDER BY pos) FILTER (WHERE {_OK}), '') AS urls FROM seen GROUP BY cell_id)"
    " SELECT cell_id AS fill, dead, conflicts, urls AS kept, CASE WHEN coalesce(len(kept), 0) > 0 THEN 'pass' WHEN cell_id % 4 = 0 THEN 'derived' ELSE 'blank' END AS outcome, CASE WHEN coalesce(len(kept), 0) >= 2 THEN 'full' WHEN len(kept) = 1 THEN 'partial' ELSE 'none' END AS level FROM per"
)
def g04_gate_fills(spark, sf):
    from fairlead.operators.gate import gate_fills

    urls = F.array(*[page_url(spark, sf, F.col("cell_id") + k) for k in (0, 7, 13)])
    fills = accepted(spark, sf).select(F.col("cell_id").alias("fill"), "value", urls.alias("urls"), (F.col("cell_id") % 4 == 0).alias("derivable"))
    return gate_fills(fills, _pages(spark, sf))


_LINKS = " || ".join(SPLIT_REFS(c) for c in REF_COLUMNS)


@query(
    f"WITH l AS (SELECT unnest({_LINKS}) AS url FROM apply_rows), c AS (SELECT url, count(*) AS cells FROM l WHERE regexp_matches(url, '^(?i)https?://') GROUP BY url) SELECT url, cells, 'HTTP 404' AS fault FROM c WHERE length(url) % 17 = 0"
)
def g07_dead_links(spark, sf):
    from fairlead.operators.gate import dead_links

    sheet = rows_of(spark, sf)
    links = sheet.select(F.explode(F.concat(*[X.split_refs(F.col(c)) for c in REF_COLUMNS])).alias("url")).distinct()
    pages = links.select("url", F.when(F.length("url") % 17 == 0, "404").otherwise("200").alias("status"), F.lit("").alias("html"))
    return dead_links(sheet, REF_COLUMNS, pages)

