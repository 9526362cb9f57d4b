"""Names to tags through ordered alias tables, and what is known of each tag."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions.text import clean_org, fold_accents, squash, strip
from fairlead.operators.skew import skew_join
from fairlead.schema import require

#: A facts cell with this value is known to differ between things of one tag and is never applied.
AMBIGUOUS = "AMBIGUOUS"
MOST_ALIASES = 200_000

# Shipyard aliases, first match wins.
BUILDER_ALIASES = [
    ("samsung heavy industries", "samsung"), ("samsung hi", "samsung"), ("samsung shipbuilding", "samsung"), ("shi geoje", "samsung"),
    ("hanwha ocean", "hanwha-ocean"), ("daewoo shipbuilding", "hanwha-ocean"), ("dsme", "hanwha-ocean"), ("daewoo marine", "hanwha-ocean"),
    ("hd hyundai heavy industries", "hyundai-ulsan"), ("hyundai heavy industries", "hyundai-ulsan"), ("hd hhi", "hyundai-ulsan"),
    ("hd hyundai samho", "hyundai-samho"), ("hyundai samho heavy industries", "hyundai-samho"), ("hd hyundai mipo", "hyundai-mipo"),
    ("hyundai mipo dockyard", "hyundai-mipo"), ("hd kshi", "hd-ksoe"), ("hd korea shipbuilding", "hd-ksoe"), ("jiangnan shipyard", "jiangnan"),
    ("hudong-zhonghua shipbuilding", "hudong-zhonghua"), ("hudong zhonghua", "hudong-zhonghua"), ("dalian shipbuilding industry", "dsic"),
    ("dalian shipbuilding", "dsic"), ("dsic", "dsic"), ("china merchants heavy industries", "cmhi"), ("cmhi haimen", "cmhi"), ("cmhi jiangsu", "cmhi"),
    ("nantong cosco khi", "nacks"), ("dalian cosco khi", "dacks"), ("cosco shipping heavy industries (yangzhou)", "cosco-yangzhou"),
    ("cosco hi, yangzhou", "cosco-yangzhou"), ("cosco hi, qidong", "cosco-qidong"), ("cosco hi, dalian", "cosco-dalian"),
    ("cosco hi, zhoushan", "cosco-zhoushan"), ("yantai cimc raffles", "yantai-cimc"), ("mitsubishi heavy industries", "mitsubishi"),
    ("mitsubishi hi", "mitsubishi"), ("kawasaki shipbuilding", "kawasaki"), ("imabari shipbuilding", "imabari"), ("japan marine united", "jmu"),
    ("jmu tsu", "jmu-tsu"), ("jmu ariake", "jmu-ariake"), ("zvezda shipbuilding", "zvezda"),
]
# Shipowner aliases, first match wins.
OWNER_ALIASES = [
    ("maran gas maritime", "maran-gas"), ("maran gas", "maran-gas"), ("angelicoussis", "maran-gas"), ("alpha gas", "alpha-gas"), ("alpha tankers", "alpha-gas"),
    ("tsakos energy", "tsakos"), ("tsakos group", "tsakos"), ("tms cardiff gas", "tms-cardiff"), ("tms cardiff", "tms-cardiff"), ("dynagas", "dynagas"),
    ("capital gas", "capital"), ("capital product partners", "capital"), ("capital clean energy", "capital"), ("capital clean ecc", "capital"),
    ("eastern pacific shipping", "eps"), ("ocean network express", "one"), ("knutsen oas", "knutsen"), ("knutsen group", "knutsen"),
    ("celsius shipping", "celsius"), ("celsius tankers", "celsius"), ("cool company", "cool-co"), ("cool co", "cool-co"), ("bw lng", "bw-lng"), ("bw group", "bw-lng"),
    ("purus marine", "purus"), ("purus marine services", "purus"), ("hayfin capital", "hayfin"), ("seapeak", "seapeak"), ("stonepeak", "stonepeak"),
    ("sonangol", "sonangol"), ("bonny gas transport", "bgt"), ("bgt", "bgt"), ("misc berhad", "misc"), ("misc bhd", "misc"), ("malaysia int shpg", "misc"),
    ("qatargas", "qatargas"), ("nakilat", "nakilat"), ("shandong marine", "shandong-marine"), ("cosco shipping energy", "cosco-shipping-energy"),
    ("china merchants energy", "china-merchants-energy"), ("minsheng financial leasing", "minsheng"), ("nyk line", "nyk"), ("nyk", "nyk"),
    ("mitsui osk lines", "mol"), ("mol", "mol"), ("k-line", "k-line"), ("kawasaki kisen kaisha", "k-line"), ("cheniere", "cheniere"),
    ("venture global lng", "venture-global"), ("qatarenergy", "qatarenergy"), ("shell", "shell"), ("bp", "bp"), ("totalenergies", "totalenergies"),
    ("woodside", "woodside"), ("adnoc", "adnoc"), ("nextdecade", "nextdecade"), ("hyundai glovis", "glovis"), ("glovis", "glovis"),
    ("oceonix services", "oceonix"), ("itochu", "itochu"),
]
# Aliases of lessors of storage units; a cell may name several.
LESSOR_ALIASES = [
    ("energos", "energos"), ("hoegh", "hoegh"), ("karmol", "karmol"), ("karpowership", "karmol"), ("snam", "snam"), ("excelerate", "excelerate"),
    ("mitsui osk", "mol"), ("mol", "mol"), ("bw lng", "bw"), ("bw ", "bw"), ("bw,", "bw"), ("swan energy", "swan"), ("exmar", "exmar"), ("gazprom", "gazprom"),
    ("botas", "botas"), ("gaslog", "gaslog"), ("klaipedos", "klaipedos-nafta"), ("lng hrvatska", "lng-croatia"), ("lng croatia", "lng-croatia"),
]
# Spellings to write, by tag; and yard words dropped before a hull number, first match only.
OWNER_DISPLAY = [("cosco-shipping-energy", "COSCO")]
HULL_PREFIXES = [
    "samsung hi geoje ", "samsung hi ", "samsung ", "hanwha ocean ", "hanwha ", "hd hyundai samho ", "hyundai samho ", "samho ", "hd hyundai ulsan ",
    "hyundai ulsan ", "ulsan ", "hhi ", "hd hyundai mipo ", "hyundai mipo ", "mipo ", "jiangnan ", "hudong-zhonghua ", "hudong ", "dsic ", "cmhi ",
]


def hull_key(c: Column) -> Column:
    """Lower case, stripped, without the first yard word that fits."""
    return strip(F.regexp_replace(strip(F.lower(c)), "^(" + "|".join(p.replace("-", r"\-") for p in HULL_PREFIXES) + ")", ""))


class _First:
    """Finds the alias of the lowest order contained in a text, in one pass over the text."""

    def __init__(self, aliases: list[tuple[str, str]]):
        self.tags: list[str] = [t for _, t in aliases]
        keys: dict[str, int] = {}
        for k, (alias, _) in enumerate(aliases):
            keys.setdefault(alias, k)
        self.keys = keys
        try:
            import ahocorasick
        except ImportError:
            self.automaton = None
        else:
            self.automaton = ahocorasick.Automaton()
            for alias, k in keys.items():
                if alias:
                    self.automaton.add_word(alias, k)
            if keys:
                self.automaton.make_automaton()

    def __call__(self, text: str) -> str:
        if not text or not self.keys:
            return text
        if self.automaton is not None:
            k = min((k for _, k in self.automaton.iter(text)), default=None)
        else:
            k = min((k for alias, k in self.keys.items() if alias in text), default=None)
        return text if k is None else self.tags[k]


def alias_list(aliases: DataFrame) -> list[tuple[str, str]]:
    """(key, tag) pairs of an alias table (ord, key, tag), in order; its size is checked because every executor holds it."""
    rows = require(aliases, "ord", "key", "tag").where(F.col("key") != "").orderBy("ord", "key").limit(MOST_ALIASES + 1).collect()
    if len(rows) > MOST_ALIASES:
        raise ValueError(f"more than {MOST_ALIASES} aliases")
    return [(r.key, r.tag) for r in rows]


def first_alias(cleaned: Column, aliases: list[tuple[str, str]]) -> Column:
    """Tag of the first alias contained in a cleaned text, else the text.

    An automaton over Arrow batches: the cost doesn't grow with the table, and each batch resolves its distinct texts only.
    """
    held: list[_First] = []

    @F.pandas_udf(T.StringType())
    def tag(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(_First(aliases))
        codes, names = pd.factorize(texts)
        found = np.array([*map(held[0], names), None], object)
        return pd.Series(found[codes])

    return tag(cleaned)


def tag_names(df: DataFrame, aliases: dict[tuple[str, str], list[tuple[str, str]]]) -> DataFrame:
    """df with a tag column for each (column, tag column) of ``aliases``. Blank names give ''.

    All are resolved in one pass where the rows lie: nothing is shuffled, and df is read once.
    """
    return df.withColumns({out: first_alias(clean_org(F.coalesce(F.col(column), F.lit(""))), known) for (column, out), known in aliases.items()})


def lessor_tags(c: Column, aliases: list[tuple[str, str]]) -> Column:
    """Distinct tags of a cell that may name several organisations, as a sorted array."""
    pieces = F.split(F.lower(fold_accents(F.coalesce(c, F.lit("")))), "[,/&]| and ")
    bare = F.filter(F.transform(pieces, lambda p: squash(F.regexp_replace(p, r"\([^)]*\)", " "))), lambda p: p != "")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def resolve(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = _First(aliases)
        for s in lists:
            yield s.map(lambda v: sorted({find(x) for x in v}))

    return resolve(bare)


def usable(c: Column) -> Column:
    """A facts cell that may be applied; null if blank or AMBIGUOUS."""
    v = strip(c)
    return F.when((v != "") & (v != AMBIGUOUS), v)


def facts_table(df: DataFrame, tag: str) -> DataFrame:
    """One row per non-blank tag with stripped cells; of repeated tags the greatest row stays."""
    rest = [c for c in df.columns if c != tag]
    own = df.select(strip(F.col(tag)).alias(tag), *[strip(F.col(c)).alias(c) for c in rest]).where(F.col(tag) != "")
    return own.groupBy(tag).agg(F.max(F.struct(*rest)).alias("_f")).select(tag, *[F.col(f"_f.{c}").alias(c) for c in rest])


def derive_unambiguous(rows: DataFrame, tag: str, value: str, ref: str, order: str) -> DataFrame:
    """(tag, value, ref, seen): a tag's value if its rows agree on one, else AMBIGUOUS with a blank ref; ref is the first non-blank one."""
    own = rows.select(F.col(tag).alias("tag"), strip(F.col(value)).alias("v"), strip(F.col(ref)).alias("r"), F.col(order).alias("o")).where("tag <> ''")
    spread = own.groupBy("tag").agg(
        F.min(F.when(F.col("v") != "", F.col("v"))).alias("lo"), F.max(F.when(F.col("v") != "", F.col("v"))).alias("hi"),
        F.min_by(F.when(F.col("r") != "", F.col("r")), F.when(F.col("r") != "", F.col("o"))).alias("r"), F.count(F.lit(1)).alias("seen"),
    ).where("lo is not null")
    same = F.col("lo") == F.col("hi")
    return spread.select("tag", F.when(same, F.col("lo")).otherwise(AMBIGUOUS).alias("value"), F.when(same, F.coalesce("r", F.lit(""))).otherwise("").alias("ref"), "seen")


def fullest_block(rows: DataFrame, tag: str, block: list[str], order: str) -> DataFrame:
    """Per tag the row with most non-blank cells of ``block``; of equals the first by ``order``; blocks without any cell are never chosen."""
    own = rows.select(F.col(tag).alias("tag"), *[strip(F.col(c)).alias(c) for c in block], F.col(order).alias("_o")).where("tag <> ''")
    score = sum((F.when(F.col(c) != "", 1).otherwise(0) for c in block), F.lit(0))
    best = own.withColumn("_score", score).where("_score > 0").groupBy("tag").agg(F.max_by(F.struct(*block), F.struct(F.col("_score"), -F.col("_o"))).alias("_b"), F.max("_score").alias("filled"))
    return best.select("tag", "filled", *[F.col(f"_b.{c}").alias(c) for c in block])


def table_first(curated: DataFrame, derived: DataFrame, tag: str, block: list[str]) -> DataFrame:
    """Curated cells that are usable win, derived ones fill the rest; tags come from either side."""
    a = curated.select(tag, *[usable(F.col(c)).alias(f"_a_{c}") for c in block])
    b = derived.select(tag, *[usable(F.col(c)).alias(f"_b_{c}") for c in block])
    return a.join(b, tag, "full").select(tag, *[F.coalesce(f"_a_{c}", f"_b_{c}", F.lit("")).alias(c) for c in block])


def merge_facts(curated: DataFrame, derived: DataFrame, tag: str, value: str, overwrite: bool = False) -> DataFrame:
    """(tag, value, status): new tags are added, differing ones kept (or overwritten) and reported."""
    a, b = curated.select(tag, strip(F.col(value)).alias("_a")), derived.select(tag, strip(F.col(value)).alias("_b"))
    both = a.join(b, tag, "full")
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "kept").when(F.col("_a") == F.col("_b"), "same").otherwise("overwritten" if overwrite else "differs")
    pick = F.coalesce(F.col("_b"), F.col("_a")) if overwrite else F.coalesce(F.col("_a"), F.col("_b"))
    return both.select(tag, pick.alias(value), status.alias("status"))
