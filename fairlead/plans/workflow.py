"""Further queries over the tracker's tables: rows and proposals on their way, reports, set operations, gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.functions import parse as P
from fairlead.functions import text as X
from fairlead.operators import gate, lookup, patch, proposals, quality, reconcile
from fairlead.operators.orphans import whole_number
from fairlead.operators.skew import skew_join
from fairlead.plans import problems
from fairlead.plans import sheet as SH
from fairlead.plans.sheet import S, SQ, TAGGED, VESSEL_KEY, accepted, by_key, rows_of, tagged
from fairlead.schema import YARD_BLOCK, table
from fairlead.sources import pages as pg
from fairlead.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


s = lambda c: X.strip(F.col(c))
n_rows = lambda name="n": F.count(F.lit(1)).alias(name)


# ---- names, titles, labels ----------------------------------------------------------------------------------------

_SLOT = r"(?i)^\s*$|\b(tbn|tba|tbd|unknown|newbuild|new build|hull\b|hull no|hull number|to be named|n/?a)\b"


@query(f"SELECT record_id, regexp_matches({S('vessel_name')}, '{_SLOT}') OR ({S('hull_number')} <> '' AND lower({S('vessel_name')}) = lower({S('hull_number')})) AS slot FROM apply_rows")
def x13_slot_names(spark, sf):
    slot = s("vessel_name").rlike(_SLOT) | ((s("hull_number") != "") & (F.lower(s("vessel_name")) == F.lower(s("hull_number"))))
    return rows_of(spark, sf).select("record_id", slot.alias("slot"))


@query("SELECT 'https://pages.example/' || CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 13 = 0 THEN 'Page not found' ELSE source END AS title, CASE WHEN doc_id % 11 = 0 THEN 'HTTP 404' WHEN doc_id % 13 = 0 THEN 'soft error: not found' END AS fault FROM documents")
def x19_page_faults(spark, sf):
    return SH._pages(spark, sf).select("url", gate.title_of(F.col("html")).alias("title"), gate.page_fault(F.col("status"), F.col("html")).alias("fault"))


@query("SELECT record_id, coalesce(operator_charterer, '') AS text FROM apply_rows")
def x20_unescape(spark, sf):
    c = F.coalesce("operator_charterer", F.lit(""))
    for ch, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(ch), F.lit(entity))
    return rows_of(spark, sf).select("record_id", X.unescape_html(c).alias("text"))


@query("SELECT idx, CASE WHEN size_agrees IS NULL THEN '?' WHEN size_agrees THEN 'yes' ELSE 'NO' END AS size_label FROM (" + SH.ORACLES["m11_pair_differences"] + ")")
def x21_tri_labels(spark, sf):
    return SH.m11_pair_differences(spark, sf).select("idx", X.tri_label(F.col("size_agrees")).alias("size_label"))


@query("SELECT column_name, count(*) AS cells FROM apply_accepted WHERE regexp_matches(accepted_value, '(?i)https?://') AND column_name LIKE '%\\_ref' ESCAPE '\\' GROUP BY column_name")
def x22_link_cells(spark, sf):
    own = table(spark, sf, "apply_accepted")
    return own.where(X.looks_url(F.col("accepted_value")) & F.endswith("column_name", F.lit("_ref"))).groupBy("column_name").agg(n_rows("cells"))


@query("SELECT doc_id AS claim, contains(replace(upper(CASE WHEN doc_id % 13 = 0 THEN 'Page not found' ELSE source END), ' ', '-'), 'NOT-FOUND') AS ok FROM documents")
def x25_title_labels(spark, sf):
    labels = table(spark, sf, "documents").select(F.col("doc_id").alias("claim"), F.expr(SH._PAGE_URL).alias("url"), F.lit("not found").alias("label"))
    return gate.title_has(SH._pages(spark, sf), labels)


@query(f"SELECT record_id, 'row ' || coalesce(row_id, '?') || ': ' || {S('vessel_name')} || ' / ' || {S('shipbuilder')} AS label FROM apply_rows")
def x26_row_labels(spark, sf):
    return rows_of(spark, sf).select("record_id", F.concat(F.lit("row "), F.coalesce("row_id", F.lit("?")), F.lit(": "), s("vessel_name"), F.lit(" / "), s("shipbuilder")).alias("label"))


# ---- rows and decisions -------------------------------------------------------------------------------------------


@query(f"SELECT row_id, max(record_id) AS last_record, count(*) AS n FROM apply_rows WHERE {S('row_id')} <> '' GROUP BY row_id")
def s06_row_map(spark, sf):
    return rows_of(spark, sf).where(s("row_id") != "").groupBy("row_id").agg(F.max("record_id").alias("last_record"), n_rows())


_DEC = SH._DEC


@query(f"WITH {_DEC} SELECT item_id, max(lower({S('decision')})) AS decision FROM last WHERE {S('decision')} <> '' GROUP BY item_id")
def s11_decisions(spark, sf):
    d = SH._decisions(spark, sf)
    return d.where(s("decision") != "").groupBy("item_id").agg(F.max(F.lower(s("decision"))).alias("decision"))


_BASE = SH.APPENDED
_GIVEN = " OR ".join(f"{S(c)} <> ''" for c in _BASE)


@query(f"WITH {SH._KEYED}, rev AS ({SH.ORACLES['m08_append_pivot']}), r AS (SELECT * FROM rev WHERE {_GIVEN}) SELECT key, {', '.join(_BASE)} FROM r UNION ALL SELECT key, {', '.join(_BASE)} FROM byrow WHERE key NOT IN (SELECT key FROM r)")
def s21_base_first(spark, sf):
    """The sheet with the rows of accepted cells, as far as they are given, in place of the live ones."""
    return patch.base_first(by_key(spark, sf), SH.m08_append_pivot(spark, sf), _BASE)


@query(f"SELECT record_id, CASE WHEN n IS NULL THEN 'unknown' WHEN n < 50000 THEN 'below' WHEN n <= 80000 THEN 'review' ELSE 'above' END AS band FROM (SELECT record_id, {SH.NUM('capacity')} AS n FROM apply_rows)")
def f10_size_bands(spark, sf):
    n = P.number(F.col("capacity"))
    band = F.when(n.isNull(), "unknown").when(n < 50_000, "below").when(n <= 80_000, "review").otherwise("above")
    return rows_of(spark, sf).select("record_id", band.alias("band"))


@query(f"WITH {_DEC} SELECT decision_id, CASE WHEN coalesce(derivable, false) OR confidence = 'G' THEN 'accept' ELSE 'hold' END AS suggested FROM last")
def f12_suggested(spark, sf):
    d = SH._decisions(spark, sf)
    return d.select("decision_id", F.when(F.coalesce("derivable", F.lit(False)) | F.coalesce(F.col("confidence") == "G", F.lit(False)), "accept").otherwise("hold").alias("suggested"))


_HOSTS = ["hullwatch.example", "gasberth.example"]


@query(f"SELECT record_id, array_to_string([x FOR x IN {SH.SPLIT_REFS('hull_number_ref')} IF NOT regexp_matches(x, '(?i)^https?://([^/]*\\.)?({'|'.join(h.replace('.', '[.]') for h in _HOSTS)})(/|$)')], ', ') AS links FROM apply_rows")
def f16_without_hosts(spark, sf):
    """Links of cells without those of given hosts; which hosts are out is a parameter, not a rule of this library."""
    pattern = "(?i)^https?://([^/]*\\.)?(" + "|".join(h.replace(".", "[.]") for h in _HOSTS) + ")(/|$)"
    return rows_of(spark, sf).select("record_id", F.array_join(F.filter(X.split_refs(F.col("hull_number_ref")), lambda x: ~x.rlike(pattern)), ", ").alias("links"))


@query(f"WITH {_DEC} SELECT decision_id, CASE WHEN {S('row_id')} <> '' THEN row_id || '|' || coalesce(column_name, '') ELSE 'cluster:' || coalesce(cluster_id, '') END AS item, coalesce(proposed_value, '') AS value FROM last")
def p01_items(spark, sf):
    raw = table(spark, sf, "decisions")
    d = proposals.first_wins(raw.select("decision_id", (-F.unix_micros(F.col("loaded_at").cast("timestamp"))).alias("_o"), "item_id", "row_id", "cluster_id", "column_name", "proposed_value"), ["decision_id"], ["_o"])
    item = F.when(s("row_id") != "", F.concat(F.col("row_id"), F.lit("|"), F.coalesce("column_name", F.lit("")))).otherwise(F.concat(F.lit("cluster:"), F.coalesce("cluster_id", F.lit(""))))
    return d.select("decision_id", item.alias("item"), F.coalesce("proposed_value", F.lit("")).alias("value"))


@query(f"SELECT {S('row_id')} AS row_id, {S('column_name')} AS column_name, '' AS existing, {S('proposed_value')} AS proposed, {S('note')} AS note, 'hold' AS decision FROM decisions")
def p02_finding_rows(spark, sf):
    d = table(spark, sf, "decisions")
    names = {"row_id": "row_id", "field": "column_name", "proposed_value": "proposed_value", "note": "note"}
    values = F.create_map(*[x for k, c in names.items() for x in (F.lit(k), F.col(c))])
    return proposals.finding_rows(d.select(values.alias("values"), F.lit(None).cast("string").alias("text")))


_FLEET_TAG = "fb AS (SELECT fleet_id, coalesce((SELECT arg_min(k, o) FROM builder_alias WHERE contains(c, k)), c) AS tag FROM (SELECT fleet_id, " + SH.CLEAN("builder") + " AS c FROM giignl_fsru_fleet))"


@query(f"WITH {TAGGED}, {_FLEET_TAG} SELECT fleet_id, " + ", ".join(f"coalesce({SH._USABLE('f.' + c)}, '') AS {c}" for c in YARD_BLOCK) + " FROM fb LEFT JOIN shipbuilder_facts f ON fb.tag = f.builder_tag")
def p04_yard_overlay(spark, sf):
    fleet = lookup.tag_names(table(spark, sf, "giignl_fsru_fleet").select("fleet_id", "builder"), {("builder", "tag"): SH.builder_aliases(spark, sf)})
    facts = lookup.facts_table(table(spark, sf, "shipbuilder_facts").withColumnRenamed("builder_tag", "tag"), "tag")
    return skew_join(fleet, facts, "tag", "left").select("fleet_id", *[F.coalesce(lookup.usable(F.col(c)), F.lit("")).alias(c) for c in YARD_BLOCK])


@query(f"WITH {TAGGED} SELECT record_id, CASE WHEN owner_tag = 'zelbrastad sea transport' THEN 'ZST' ELSE coalesce(shipowner, '') END AS display FROM sheet")
def p06_display_names(spark, sf):
    shown = spark.createDataFrame([("zelbrastad sea transport", "ZST"), *lookup.OWNER_DISPLAY], "owner_tag string, shown string")
    return skew_join(tagged(spark, sf, "record_id"), shown, "owner_tag", "left").select("record_id", F.coalesce("shown", "shipowner", F.lit("")).alias("display"))


_GRID = ["capacity", "cargo_type", "vessel_type", "delivery_year"]


@query(
    f"WITH {SH._KEYED}, {SH._ACC}, p AS (SELECT key, column_name, max((confidence, value)) AS m FROM (SELECT key, column_name, coalesce(confidence, '') AS confidence, coalesce(value, '') AS value FROM acc WHERE key IS NOT NULL) GROUP BY ALL), c AS ("
    + " UNION ALL ".join(f"SELECT key, '{c}' AS column_name, coalesce({c}, '') AS old FROM byrow" for c in _GRID)
    + ") SELECT c.key, c.column_name, coalesce(m[2], old) AS value, CASE WHEN m IS NOT NULL THEN CASE m[1] WHEN 'G' THEN 'green' WHEN 'Y' THEN 'yellow' ELSE 'red' END WHEN old <> '' THEN 'gray' ELSE '' END AS fill FROM c LEFT JOIN p ON c.key = p.key AND c.column_name = p.column_name"
)
def p09_styled_cells(spark, sf):
    own = accepted(spark, sf).where("key is not null").select("key", "column_name", F.coalesce("value", F.lit("")).alias("value"), F.coalesce("confidence", F.lit("")).alias("confidence"))
    return sinks.styled_cells(by_key(spark, sf).select("key", *_GRID), own, "key", _GRID)


# ---- joins --------------------------------------------------------------------------------------------------------


@query(f"WITH {SH._KEYED}, {_DEC} SELECT decision_id, s.record_id, {S('s.vessel_name')} AS vessel_name FROM last d LEFT JOIN byrow s ON {SH._WHOLE.format(c='d.row_id')} = s.key")
def j01_row_lookup(spark, sf):
    d = SH._decisions(spark, sf).select("decision_id", whole_number(F.col("row_id")).alias("key"))
    return skew_join(d, by_key(spark, sf).select("key", "record_id", "vessel_name"), "key", "left").select("decision_id", "record_id", F.when(F.col("record_id").isNotNull(), s("vessel_name")).otherwise("").alias("vessel_name"))


_KEYS_OF = "SELECT {i} AS id, {b} AS builder, {h} AS hull, {o} AS owner, {m} AS month FROM {t}"
_ORDERS = _KEYS_OF.format(i="raw_id", b=SH.CLEAN("f[19]"), h=SH.S(SH._HULL.replace("hull_number", "f[9]")), o=SH.CLEAN("f[15]"), m=SH.MONTH("f[42]"), t="vals v JOIN reasons USING (raw_id) WHERE len([x FOR x IN r IF x IS NOT NULL]) = 0")
_INDEXED = _KEYS_OF.format(i="record_id", b=SH.CLEAN("shipbuilder"), h=SH.S(SH._HULL), o=SH.CLEAN("shipowner"), m=SH.MONTH("contract_date"), t="apply_rows")


@query(
    problems._P1 + f", o AS ({_ORDERS}), i AS ({_INDEXED}) SELECT id AS raw_id FROM o WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.builder = o.builder AND i.hull = o.hull AND i.builder <> '' AND i.hull <> '')"
    " AND NOT EXISTS (SELECT 1 FROM i WHERE i.builder = o.builder AND i.owner = o.owner AND i.month = o.month AND i.builder <> '' AND i.owner <> '' AND i.month <> '')"
)
def j15_orders_not_indexed(spark, sf):
    """Loaded raw rows that the sheet has neither by yard and hull nor by yard, owner and month."""
    from fairlead.sources.raw_records import sound_rows

    keys = lambda df, i: df.select(F.col(i).alias("id"), X.clean_org(F.col("shipbuilder")).alias("builder"), lookup.hull_key(F.col("hull_number")).alias("hull"), X.clean_org(F.col("shipowner")).alias("owner"), P.month_key(F.col("contract_date")).alias("month"))
    orders, index = keys(sound_rows(problems._parsed(spark, sf), "raw_id"), "raw_id"), keys(rows_of(spark, sf), "record_id")
    for cols in (["builder", "hull"], ["builder", "owner", "month"]):
        given = F.lit(True)
        for c in cols:
            given = given & (F.col(c) != "")
        orders = orders.join(index.where(given).select(*cols).distinct(), cols, "left_anti")
    return orders.select(F.col("id").alias("raw_id"))


@query(
    "WITH " + ", ".join(f"{a} AS (SELECT check_id, max(loaded_at) AS l, " + ", ".join(f"arg_max({S(c)}, loaded_at) AS {c}" for c in SH._FIELDS) + f" FROM {t} GROUP BY check_id)" for a, t in (("a", "verify_report"), ("b", "verify_rerun")))
    + " SELECT check_id, a.status AS status, CASE WHEN b.accepted_value <> '' THEN b.accepted_value ELSE a.accepted_value END AS accepted_value, CASE WHEN a.l > b.l THEN a.backend_value ELSE b.backend_value END AS backend_value FROM a JOIN b USING (check_id)"
)
def j19_precedence(spark, sf):
    """One row of two copies: a field from the left, one from the right where it is given, one from whichever is newer."""
    side = lambda t, n: table(spark, sf, t).groupBy("check_id").agg(F.max(F.struct("loaded_at", *SH._FIELDS)).alias(n))
    both = side("verify_report", "a").join(side("verify_rerun", "b"), "check_id")
    return both.select("check_id", s("a.status").alias("status"), F.when(s("b.accepted_value") != "", s("b.accepted_value")).otherwise(s("a.accepted_value")).alias("accepted_value"), F.when(F.col("a.loaded_at") > F.col("b.loaded_at"), s("a.backend_value")).otherwise(s("b.backend_value")).alias("backend_value"))


@query(f"SELECT record_id, CASE WHEN {S('hull_number')} NOT IN ('', 'unknown') THEN {S('hull_number')} ELSE nullif(regexp_extract({S('vessel_name')}, '\\b(\\d{{4}}[A-Z]?)\\b', 1), '') END AS hull FROM apply_rows")
def j20_hull_backfill(spark, sf):
    parsed = F.regexp_extract(s("vessel_name"), r"\b(\d{4}[A-Z]?)\b", 1)
    return rows_of(spark, sf).select("record_id", F.when(~s("hull_number").isin("", "unknown"), s("hull_number")).otherwise(F.when(parsed != "", parsed)).alias("hull"))


@query(f"WITH {TAGGED} SELECT owner_tag, count(*) AS rows, min(record_id) AS first_record FROM sheet WHERE regexp_replace(coalesce(imo_number, ''), '[^0-9]', '', 'g') = '' GROUP BY owner_tag")
def j21_rows_without_number(spark, sf):
    return tagged(spark, sf, "record_id", "imo_number").where(P.digits(F.col("imo_number")) == "").groupBy("owner_tag").agg(n_rows("rows"), F.min("record_id").alias("first_record"))


@query(
    f"WITH named AS (SELECT DISTINCT {VESSEL_KEY('vessel_name')} AS key FROM giignl_fsru_fleet) SELECT record_id, CASE WHEN {S('vessel_type')} = 'FSRU' AND {S('notes')} <> '' THEN 'noted' WHEN {S('vessel_type')} = 'FSRU' THEN 'unnoted' ELSE '' END AS triage FROM apply_rows WHERE {VESSEL_KEY('vessel_name')} NOT IN (SELECT key FROM named)"
)
def j23_triage(spark, sf):
    named = table(spark, sf, "giignl_fsru_fleet").select(X.vessel_key(F.coalesce("vessel_name", F.lit(""))).alias("key")).distinct()
    own = rows_of(spark, sf).withColumn("key", X.vessel_key(F.coalesce("vessel_name", F.lit("")))).join(named, "key", "left_anti")
    fsru = s("vessel_type") == "FSRU"
    return own.select("record_id", F.when(fsru & (s("notes") != ""), "noted").when(fsru, "unnoted").otherwise("").alias("triage"))


@query(
    f"WITH {TAGGED}, r AS (SELECT record_id, {VESSEL_KEY('vessel_name')} AS key, owner_tag, builder_tag, regexp_replace(coalesce(imo_number, ''), '[^0-9]', '', 'g') AS imo FROM sheet) SELECT a.record_id AS left_id, min(b.record_id) AS right_id FROM r a JOIN r b ON a.key = b.key AND a.owner_tag = b.owner_tag AND a.builder_tag = b.builder_tag AND a.key <> '' AND a.owner_tag <> '' AND a.builder_tag <> ''"
    " WHERE a.imo <> '' AND b.imo = '' GROUP BY a.record_id"
)
def j24_id_repairs(spark, sf):
    """Rows with an id and the first row without one of the same name, yard and owner: candidates for people to look at."""
    own = tagged(spark, sf, "record_id", "vessel_name", "imo_number").select("record_id", F.concat_ws("|", X.vessel_key(F.coalesce("vessel_name", F.lit(""))), "owner_tag", "builder_tag").alias("key"), P.digits(F.col("imo_number")).alias("imo"), X.vessel_key(F.coalesce("vessel_name", F.lit(""))).alias("n"), "owner_tag", "builder_tag").where("n <> '' and owner_tag <> '' and builder_tag <> ''")
    bare = own.where("imo = ''").groupBy("key").agg(F.min("record_id").alias("right_id"))
    return skew_join(own.where("imo <> ''").select("record_id", "key"), bare, "key").select(F.col("record_id").alias("left_id"), "right_id")


# ---- aggregates, sorts, sets --------------------------------------------------------------------------------------


@query(f"WITH {_DEC}, r AS (SELECT {SH._WHOLE.format(c='row_id')} AS key, CASE WHEN confidence = 'G' THEN 3 WHEN confidence = 'Y' THEN 2 WHEN confidence = 'R' THEN 1 ELSE 0 END AS rank FROM last) SELECT key, max(rank) AS best, count(*) AS n FROM r WHERE key IS NOT NULL GROUP BY key")
def a06_best_confidence(spark, sf):
    rank = F.when(F.col("confidence") == "G", 3).when(F.col("confidence") == "Y", 2).when(F.col("confidence") == "R", 1).otherwise(0)
    return SH._decisions(spark, sf).select(whole_number(F.col("row_id")).alias("key"), rank.alias("rank")).where("key is not null").groupBy("key").agg(F.max("rank").alias("best"), n_rows())


@query("SELECT batch, count(*) AS items, count(*) FILTER (decision = 'accept') AS accepted, count(*) FILTER (decision = 'hold') AS held, count(*) FILTER (decision = 'reject') AS rejected, count(DISTINCT row_id) AS rows FROM decisions GROUP BY batch")
def a07_batch_counts(spark, sf):
    d = table(spark, sf, "decisions")
    return d.groupBy("batch").agg(n_rows("items"), *[F.count_if(F.col("decision") == v).alias(n) for v, n in (("accept", "accepted"), ("hold", "held"), ("reject", "rejected"))], F.count_distinct("row_id").alias("rows"))


@query("SELECT CAST(sum(n) AS BIGINT) AS cells FROM (SELECT " + " + ".join(f"CASE WHEN lower({S(c)}) IN ('', 'unknown') THEN 1 ELSE 0 END" for c in SH.RESEARCHED) + " AS n FROM apply_rows)")
def a11_gap_cells(spark, sf):
    return proposals.gaps(rows_of(spark, sf), SH.RESEARCHED).agg(n_rows("cells"))


@query("SELECT 'yard-' || CAST(record_id % 97 AS VARCHAR) AS yard, count(*) AS orders FROM apply_rows GROUP BY 1")
def a14_orders_per_yard(spark, sf):
    return pg.order_rows(SH._order_pages(spark, sf)).groupBy("yard").agg(n_rows("orders"))


@query(SH.ORACLES["j13_key_buckets"].replace("WITH l AS", "WITH l AS", 1).replace("SELECT CASE WHEN ln", "SELECT bucket, count(*) AS keys, CAST(sum(rows) AS BIGINT) AS rows FROM (SELECT CASE WHEN ln", 1) + ") GROUP BY bucket")
def a15_key_bucket_sizes(spark, sf):
    return SH.j13_key_buckets(spark, sf).groupBy("bucket").agg(n_rows("keys"), F.sum("rows").alias("rows"))


_TOP = 20


@query(f"WITH {SH._FOUND} SELECT record_id, column_name, check_name, severity FROM found ORDER BY CASE severity WHEN 'HIGH' THEN 0 WHEN 'MED' THEN 1 ELSE 2 END, check_name, record_id, column_name LIMIT {_TOP}")
def o05_top_findings(spark, sf):
    """The worst findings first: the limit is the feature."""
    rank = F.when(F.col("severity") == "HIGH", 0).when(F.col("severity") == "MED", 1).otherwise(2)
    return SH._findings(spark, sf).orderBy(rank, "check_name", "record_id", "column_name").limit(_TOP).select("record_id", "column_name", "check_name", "severity")


@query(f"SELECT DISTINCT {VESSEL_KEY('vessel_name')} AS name_key FROM giignl_fsru_fleet EXCEPT SELECT {VESSEL_KEY('vessel_name')} FROM apply_rows")
def o07_names_missing(spark, sf):
    key = X.vessel_key(F.coalesce("vessel_name", F.lit(""))).alias("name_key")
    return table(spark, sf, "giignl_fsru_fleet").select(key).subtract(rows_of(spark, sf).select(key))


@query(f"SELECT 'fleet' AS origin, {S('vessel_owner')} AS owner, count(*) AS n FROM giignl_fsru_fleet GROUP BY 2 UNION ALL SELECT 'sheet', {S('shipowner')}, count(*) FROM apply_rows GROUP BY 2")
def o08_union(spark, sf):
    a = table(spark, sf, "giignl_fsru_fleet").select(F.lit("fleet").alias("origin"), s("vessel_owner").alias("owner"))
    b = rows_of(spark, sf).select(F.lit("sheet").alias("origin"), s("shipowner").alias("owner"))
    return a.unionByName(b).groupBy("origin", "owner").agg(n_rows())


@query(f"SELECT record_id, {S('status')} AS status, regexp_extract(coalesce(delivery_year, ''), '((?:19|20)\\d{{2}})', 1) AS year FROM apply_rows ORDER BY CASE WHEN {S('status')} = 'on order' THEN 0 ELSE 1 END, year DESC, record_id")
def o10_on_order_first(spark, sf):
    """The list that people work through: on order first, latest delivery first."""
    own = rows_of(spark, sf).select("record_id", s("status").alias("status"), P.year(F.col("delivery_year")).alias("year"))
    return own.orderBy(F.when(F.col("status") == "on order", 0).otherwise(1), F.desc("year"), "record_id")


@query(f"WITH {SH._KEYED}, {SH._ACC} SELECT key, count(*) AS cells, CAST(max(CASE WHEN confidence = 'G' THEN 1 ELSE 0 END) AS INT) AS sure FROM acc WHERE key IS NOT NULL GROUP BY key ORDER BY coalesce(key, 0), key")
def o02_touched_rows(spark, sf):
    """The touched rows by number, as a report shows them."""
    own = accepted(spark, sf).where("key is not null")
    return own.groupBy("key").agg(n_rows("cells"), F.max((F.coalesce("confidence", F.lit("")) == "G").cast("int")).alias("sure")).orderBy(sinks.by_number("key"), "key")


# ---- gate and verification ----------------------------------------------------------------------------------------


@query("SELECT claim, CASE WHEN ok THEN url END AS url FROM (" + SH.ORACLES["g01_verify"] + ")")
def g03_supported_urls(spark, sf):
    return gate.supported_url(SH.g01_verify(spark, sf))


@query(
    "WITH " + SH.corroborated(f"SELECT cell_id, pos, cell_id * (2 * pos + 1) % {SH._PAGES} + 1 AS number, {S('value')} AS v FROM acc, (SELECT unnest([0, 1]) AS pos)", "cell_id, pos")
    + f" SELECT cell_id AS cell, pos, {SH._URL} AS url, CASE WHEN cell_id % 9 = 0 THEN 'PRESERVED' WHEN {SH._OK} THEN 'PASS' WHEN starts_with(reason, 'HTTP') AND contains({SH._URL}, 'pages.example/7') THEN 'SOFT-KEPT' WHEN regexp_matches(reason, '^(HTTP|soft error)') THEN 'DROPPED-unreachable' ELSE 'DROPPED-conflict' END AS verdict FROM seen"
)
def g05_ref_verdicts(spark, sf):
    refs = F.concat_ws("\n", *[SH.page_url(spark, sf, F.col("cell_id") * k) for k in (1, 3)])
    cells = accepted(spark, sf).select(F.col("cell_id").alias("cell"), "value", refs.alias("ref"), (F.col("cell_id") % 9 == 0).alias("preserve"))
    return gate.ref_verdicts(cells, SH._pages(spark, sf), ("pages.example/7",))


_ORG = "SELECT min(owner_tag) AS org FROM shipowner_facts"


@query(
    f"WITH p AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN '' ELSE lower(source || ' ' || text) END AS t FROM documents), o AS (SELECT row_number() OVER (ORDER BY owner_tag) - 1 AS k, owner_tag FROM shipowner_facts), c AS (SELECT doc_id, owner_tag FROM documents JOIN o ON doc_id % (SELECT count(*) FROM o) = k)"
    " SELECT c.doc_id AS claim, contains(t, owner_tag) AND contains(t, 'hull') AS ok FROM c JOIN p USING (doc_id)"
)
def g06_coherence(spark, sf):
    """Whether a page names an owner and speaks of hulls: all expected texts must be there."""
    from pyspark.sql import Window as W

    facts = table(spark, sf, "shipowner_facts").select("owner_tag")
    numbered = facts.withColumn("k", F.row_number().over(W.orderBy("owner_tag")) - 1)  # a facts table of one row per organisation
    n = numbered.count()
    claims = table(spark, sf, "documents").select(F.col("doc_id").alias("claim"), F.expr(SH._PAGE_URL).alias("url"), (F.col("doc_id") % n).cast("int").alias("k")).join(numbered, "k")
    return gate.verify(claims.select("claim", "url", F.array("owner_tag", F.lit("hull")).alias("expected")), SH._pages(spark, sf)).select("claim", "ok")


@query(f"SELECT record_id, CASE WHEN n >= 2 THEN 'G' WHEN n = 1 THEN 'Y' ELSE 'R' END AS label FROM (SELECT record_id, len(list_distinct({SH.SPLIT_REFS('capacity_ref')})) AS n FROM apply_rows)")
def g08_confidence_labels(spark, sf):
    n = F.size(F.array_distinct(X.split_refs(F.col("capacity_ref"))))
    return rows_of(spark, sf).select("record_id", F.when(n >= 2, "G").when(n == 1, "Y").otherwise("R").alias("label"))


_REF = "shipowner_ref"


@query(
    f"WITH {SH._KEYED}, {SH._ACC}, n AS (SELECT key, cell_id, unnest({SH.SPLIT_REFS('value')}) AS x, unnest(range(len({SH.SPLIT_REFS('value')}))) AS i FROM acc WHERE column_name = '{_REF}' AND key IS NOT NULL), o AS (SELECT key, unnest({SH.SPLIT_REFS(_REF)}) AS x, unnest(range(len({SH.SPLIT_REFS(_REF)}))) AS i FROM byrow WHERE key IN (SELECT key FROM n)), "
    "u AS (SELECT key, x, (0, 0, i) AS p FROM o UNION ALL SELECT key, x, (1, cell_id, i) FROM n WHERE key IN (SELECT key FROM byrow)), f AS (SELECT key, x, min(p) AS p FROM u GROUP BY ALL) SELECT key, string_agg(x, ', ' ORDER BY p) AS cell FROM f GROUP BY key"
)
def m09_merged_refs(spark, sf):
    """A reference cell with all links accepted for it appended: none is lost where several were."""
    own = accepted(spark, sf).where(f"column_name = '{_REF}' and key is not null").select("key", "cell_id", F.posexplode(X.split_refs(F.col("value"))).alias("i", "url"))
    return patch.merged_refs(by_key(spark, sf).select("key", _REF), own.select("key", F.struct("cell_id", "i").alias("pos"), "url"), _REF)


@query(
    f"WITH {SH._KEYED}, {SH._ACC}, j AS (SELECT cell_id, column_name, {SQ('acc.value')} AS value, {SQ(SH._CELL)} AS found FROM acc LEFT JOIN byrow s ON acc.key = s.key WHERE column_name IS NOT NULL) SELECT 'cells' AS part, CASE WHEN found = '' THEN 'MISSING' WHEN found = value THEN 'landed' ELSE 'MISMATCH' END AS status, count(*) AS n FROM j GROUP BY ALL"
    f" UNION ALL SELECT 'findings', check_name, count(*) FROM ({SH._Q['q09']}) q WHERE record_id IN (SELECT record_id FROM byrow JOIN acc USING (key)) GROUP BY ALL"
)
def m10_verification(spark, sf):
    """After applying: how many cells landed, and which reference findings the touched rows have."""
    cells = SH.j12_verify_cells(spark, sf).groupBy("status").agg(n_rows()).select(F.lit("cells").alias("part"), "status", "n")
    rows = by_key(spark, sf)
    touched = rows.join(accepted(spark, sf).where("key is not null").select("key").distinct(), "key", "left_semi")
    found = quality.pair_findings(touched).where("check_name = 'orphan-ref'").groupBy(F.col("check_name").alias("status")).agg(n_rows()).select(F.lit("findings").alias("part"), "status", "n")
    return cells.unionByName(found)


@query(
    f"WITH {TAGGED}, f AS ({SH.ORACLES['f07_sole_source']}) SELECT owner_tag, builder_tag, count(DISTINCT f.record_id) AS rows, count(*) AS cells FROM f JOIN sheet USING (record_id) GROUP BY ALL"
)
def m13_corroboration_targets(spark, sf):
    return proposals.gap_targets(SH.f07_sole_source(spark, sf), tagged(spark, sf, "record_id"), ["owner_tag", "builder_tag"])


@query(f"WITH {SH._NAMED}, d AS (SELECT CASE WHEN vessel_type = 'FSRU' THEN 'matched' ELSE 'reclassify' END AS bucket FROM named) SELECT bucket, count(*) AS n FROM d GROUP BY bucket")
def k12_named_counts(spark, sf):
    named = reconcile.name_join(SH._roster(spark, sf), SH._reconciled(spark, sf))
    return named.groupBy(F.when(F.col("vessel_type") == "FSRU", "matched").otherwise("reclassify").alias("bucket")).agg(n_rows())


@query(f"WITH {SH.TAGGED}, {SH._DUP}, i AS (SELECT imo AS key, count(*) AS n FROM k WHERE imo <> '' GROUP BY imo HAVING count(DISTINCT row_id) > 1), h AS (SELECT builder || '|' || hull AS key, count(*) AS n FROM k WHERE builder <> '' AND hull <> '' GROUP BY 1 HAVING count(DISTINCT row_id) > 1) SELECT 1 AS tier, 'HIGH' AS severity, 'imo' AS kind, key, n AS records FROM i UNION ALL SELECT 1, 'HIGH', 'hull', key, n FROM h")
def o01_duplicate_report(spark, sf):
    keyed = SH._keyed(spark, sf)
    from fairlead.operators.dedupe import shared_key

    both = shared_key(keyed, ["imo"], "imo").unionByName(shared_key(keyed, ["builder", "hull"], "hull"))
    return both.groupBy("kind", "key").agg(n_rows("records")).select(F.lit(1).alias("tier"), F.lit("HIGH").alias("severity"), "kind", "key", "records")




# ---- streams ------------------------------------------------------------------------------------------------------


@query(f"WITH {SH.CELLS} {SH._Q['q05']} UNION ALL {SH._Q['q10']}")
def t01_stream_findings(spark, sf):
    """The findings of q05 and q10, made by a stream over the files of the table."""
    import uuid

    from fairlead.session import shared_dir
    from fairlead.streaming.incremental import read_rows, stream_findings

    rules = [r for r in SH._rules(spark, sf) if r.check == "bad-shape" and set(r.columns) & {"capacity", "imo_number"}]
    columns = ["record_id", "row_id", "imo_number", "capacity", "capacity_units", "price", "price_currency"]
    schema = rows_of(spark, sf).select(*columns).schema
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = stream_findings(read_rows(spark, f"{sf}/apply_rows.parque[t]", schema), rules, f"{at}/out", f"{at}/state")
    run.awaitTermination()
    return spark.read.parquet(f"{at}/out").drop("batch")
