"""Records entered more than once with small edits, found with odd sketches.

A record becomes the set of the letter and digit groups of the values that identify the thing (number, name, hull):
small edits leave most of them, and things of one series, which share all other fields, share few. MinHash samples of
the set meet in bands of several; the samples folded into a parity bitmap are the odd sketch, and the exclusive-or of two
sketches estimates the similarity of each pair that met. Pairs below the threshold go; the others are compared field by
field, as sisters with neighbouring numbers may be as similar as that. Equal records are one before they meet anything.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.llm.groups import components, pairs_within
from fairlead.llm.names import cost, distance, fold, tokens_of
from fairlead.operators.skew import salted_join, skew_join, spread_join
from fairlead.schema import require
from fairlead.session import settle

SAMPLES, BITS = 224, 1792
#: Bands of MinHash samples. A band meets only where one more field agrees, another one from band to band: records of
#: different things share many letter groups, and would meet all over a large table.
ROWS, BANDS = 4, 56
QUALIFIERS = ["delivery_year", "capacity", "shipowner_country_area", "shipbuilder_yard_country_area"]
IDENTITY = ["imo_number", "vessel_name", "hull_number"]
CONTEXT = [
    "shipowner", "shipbuilder", "shipowner_country_area", "shipbuilder_yard_country_area", "capacity", "cargo_type",
    "vessel_type", "propulsion_type", "delivery_year", "contract_date", "operator_charterer", "price",
    "yard_location_latitude",
]
# Words that are added to or left off a vessel's name, and what fields hold instead of nothing.
NAME_EXTRAS = frozenset("lng lngc fsru fsu mv ms ss the".split())
NOTHING = frozenset(["", "unknown", "n/a", "na", "-", "tbd", "none", "null"])
MONTHS = {m: k for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
_SEEDS = np.random.default_rng(20260101).integers(1, 2**63, (2, SAMPLES), dtype=np.uint64) | np.uint64(1)


def number_key(text: str) -> str:
    digits = re.sub(r"\D", "", text)
    return digits if 6 <= len(digits) <= 9 else ""


def name_key(text: str) -> str:
    joined = re.sub(r"\b(lng|\w)[/.](\w)\b\.?", r"\1\2", fold(text))  # 'M/V', 'm.v.', 'LNG/C'
    words = re.findall(r"[^\W_]+", joined)
    return " ".join(sorted(w for w in words if w not in NAME_EXTRAS) or sorted(words))


def hull_key(text: str) -> str:
    found = re.findall(r"\d+[a-z]?\b", re.sub(r"\([^()]*\)", " ", fold(text)))
    return found[-1].lstrip("0") if found else ""


def date_key(text: str) -> str:
    """YYYY-MM of the date formats that people type; '' if there is none."""
    t = text.strip().lower()
    for pattern, order in ((r"(\d{1,2})/(\d{1,2})/(\d{4})", (3, 1)), (r"(\d{4})-(\d{1,2})(?:-\d{1,2})?", (1, 2)), (r"(?:\d{1,2}[- ])?([a-z]{3})[a-z]*[- ](\d{4})", (2, 1))):
        if m := re.match(pattern, t):
            month = m[order[1]]
            return f"{m[order[0]]}-{MONTHS.get(month, 0) if month.isalpha() else int(month):02d}"
    return ""


@lru_cache(maxsize=200_000)
def _clean(field: str, text: str) -> str:
    if text.strip().lower() in NOTHING:
        return ""
    if field == "imo_number":
        return number_key(text)
    if field == "vessel_name":
        return name_key(text)
    if field == "hull_number":
        return hull_key(text)
    if field == "contract_date":
        return date_key(text)
    if field in ("capacity", "price"):
        return re.sub(r"\.0*$|[, ]", "", text.strip())
    return " ".join(fold(text).split())


def clean(field: str, value: object) -> str:
    """A field's value in one form; '' if it says nothing."""
    return _clean(field, value if isinstance(value, str) else "" if value is None or value != value else str(value))


def grams_of(number: str, name: str, hull: str) -> list[str]:
    """Letter and digit groups of the identifying values, as a set in order; the name, which is seldom missing, has most."""
    marked, inner = f"^{name.replace(' ', '_')}$" if name else "", f"^{hull}$" if hull else ""
    out = [f"{kind}{text[k : k + q]}" for kind, text, sizes in (("n", number, (3, 4)), ("v", marked, (3, 4)), ("h", inner, (3,))) for q in sizes for k in range(len(text) - q + 1)]
    return list(dict.fromkeys([*out, f"H{hull}"] if hull else out))


def samples_of(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash: for each set and hash function the least hash; the sets stand end to end, none is empty."""
    mixed = hashes[:, None] * _SEEDS[0] + _SEEDS[1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.minimum.reduceat(mixed, starts, axis=0)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of BITS bits, as 64-bit words: each sample flips the bit that it and its position hash to."""
    where = (samples ^ (np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(BITS)
    at = where.astype(np.int64) + np.arange(len(samples), dtype=np.int64)[:, None] * BITS
    bits = (np.bincount(at.ravel(), minlength=len(samples) * BITS) & 1).astype(np.uint8)
    return np.packbits(bits.reshape(len(samples), BITS), axis=1).view(np.int64)


def band_keys(samples: np.ndarray, qualifiers: np.ndarray) -> np.ndarray:
    """A key for each band of ROWS samples; ``qualifiers`` has a hash of each of QUALIFIERS."""
    part = samples[:, : ROWS * BANDS].reshape(len(samples), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) ^ qualifiers[:, np.arange(BANDS) % len(QUALIFIERS)]
    for k in range(ROWS):
        key = (key ^ part[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def similarity(differing: int) -> float:
    """Jaccard similarity estimated from the number of bits in which two odd sketches differ."""
    left = 1 - 2 * differing / BITS
    return 1.0 if differing == 0 else max(0.0, 1 + BITS / (4 * SAMPLES) * np.log(left)) if left > 0 else 0.0


def most_differing(least: float) -> int:
    """The most differing bits of two sketches whose estimated similarity is at least ``least``."""
    return max(d for d in range(BITS + 1) if similarity(d) >= least)


def deletions(word: str) -> set[str]:
    """The word and all forms of it with one letter less: words one edit or swap apart share one."""
    return {word} | {word[:k] + word[k + 1 :] for k in range(len(word))}


def lone_keys(got: dict[str, str]) -> list[str]:
    """Keys for pairs of which one record has no name: equal hull, a number one edit off, or a hull one edit off where
    no other field may differ but capacity and price. Every such pair that same_thing() links at 5 shares one."""
    number, hull = got["imo_number"], got["hull_number"]
    lone = {f"d|{d}" for d in deletions(number)} if number else set()
    if hull:
        lone.add(f"h|{hull}")
        series = [got[f] for f in CONTEXT[2:] if f not in ("capacity", "price")]
        if all(series):
            lone |= {f"s|{d}|{'|'.join(series)}" for d in deletions(hull)}
    return sorted(lone)


FIELDS = [*IDENTITY, *CONTEXT]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cleaned(rows: pd.DataFrame) -> pd.Series:
    return pd.Series([[clean(f, v) for f, v in zip(FIELDS, values, strict=True)] for values in rows.itertuples(index=False, name=None)])


_LONGS = T.ArrayType(T.LongType())


@F.pandas_udf(T.StructType([T.StructField("bands", _LONGS), T.StructField("sketch", _LONGS)]))
def _sketch(cleaned: pd.Series) -> pd.DataFrame:
    memo: dict[str, int] = {}

    def hashed(text: str) -> int:
        h = memo.get(text)
        if h is None:
            h = memo[text] = xxhash.xxh3_64_intdigest(text)
        return h

    where = [FIELDS.index(f) for f in QUALIFIERS]
    hashes, starts, qualified = [], [0], []
    for c in cleaned:
        # A record of one short value has no group of its own; the values themselves are its set then.
        hashes += map(hashed, grams_of(*c[: len(IDENTITY)]) or [f"{k}={v}" for k, v in enumerate(c[: len(IDENTITY)]) if v])
        starts.append(len(hashes))
        qualified.append([hashed(f"={c[k]}") for k in where])
    flat, at, by, bands, sketches = np.array(hashes, np.uint64), np.array(starts, np.intp), np.array(qualified, np.uint64), [], []
    for k in range(0, len(cleaned), 512):  # so many sets' samples at once
        own = at[k : k + 513]
        samples = samples_of(flat[own[0] : own[-1]], own[:-1] - own[0])
        bands += list(band_keys(samples, by[k : k + 512]))
        sketches += list(odd_sketches(samples))
    return pd.DataFrame({"bands": bands, "sketch": sketches})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _lone(cleaned: pd.Series) -> pd.Series:
    return pd.Series([[int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(k)))) for k in lone_keys(dict(zip(FIELDS, c, strict=True)))] for c in cleaned])


def _name_evidence(a: str, b: str) -> float:
    if a == b:
        return 5.0
    x, y = a.split(), b.split()
    odd = lambda ws, vs: sorted(w for w in ws if w not in vs)
    left, right = odd(x, y), odd(y, x)
    if "".join(x) == "".join(y) or len(left) == len(right) == 1 and min(len(left[0]), len(right[0])) >= 4 and not any(c.isdigit() for c in left[0] + right[0]) and distance(left[0], right[0]) == 1 and left[0] not in ORDINALS and right[0] not in ORDINALS:
        return 4.0
    if distance(a.replace(" ", ""), b.replace(" ", "")) == 1 and not any(c.isdigit() for c in a + b):
        return 4.0
    return -4.0


# Words that number the vessels of one order.
ORDINALS = frozenset("one two three four five six seven eight nine ten eleven twelve i ii iii iv v vi vii viii ix x".split())


def same_thing(a: dict[str, str], b: dict[str, str]) -> float:
    """Evidence that two cleaned records are of one vessel: above 5 they are."""
    total = agree = 0.0
    number_same = bool(a["imo_number"]) and a["imo_number"] == b["imo_number"]
    if a["vessel_name"] and b["vessel_name"] and not number_same and _name_evidence(a["vessel_name"], b["vessel_name"]) < 0:
        return -9.0  # neither name nor number is the same: at most a sister
    if a["imo_number"] and b["imo_number"]:
        far = distance(a["imo_number"], b["imo_number"])
        total += 6.0 if far == 0 else 1.5 if far == 1 else -2.5 if far == 2 else -6.0
        agree += far <= 1
    if a["vessel_name"] and b["vessel_name"]:
        e = _name_evidence(a["vessel_name"], b["vessel_name"])
        total += e
        agree += e > 0
    if a["hull_number"] and b["hull_number"]:
        x, y = a["hull_number"], b["hull_number"]
        same = x == y
        swapped = sorted(x) == sorted(y) and distance(x, y) == 1
        dropped = abs(len(x) - len(y)) == 1 and distance(x, y) == 1
        total += 4.0 if same else 0.5 if swapped or dropped else -1.5 if distance(x, y) == 1 else -4.0
        agree += same or swapped or dropped
    for f in ("shipowner", "shipbuilder"):
        if a[f] and b[f]:
            x, y = tokens_of(a[f]), tokens_of(b[f])
            total += 0.7 if x == y or cost(x, y) <= 9 or cost(y, x) <= 9 or (x and y and x[0] in y) else -0.7
    for f in CONTEXT[2:]:
        if a[f] and b[f]:
            if a[f] == b[f]:
                total += 0.3
            elif f in ("capacity", "price"):
                p, q = (float(v) if re.fullmatch(r"\d+(\.\d+)?", v) else 0.0 for v in (a[f], b[f]))
                total += 0.1 if p and q and abs(p - q) <= 0.02 * max(p, q) else -0.8
            elif f == "delivery_year":
                total += 0.0 if a[f].isdigit() and b[f].isdigit() and abs(int(a[f]) - int(b[f])) <= 1 else -0.8
            else:
                total -= 0.6
    return total if agree else -9.0


def sketched_pairs(firsts: DataFrame, least_similarity: float) -> DataFrame:
    """(a, b) of firsts (id, cleaned) that share a band and whose odd sketches estimate at least ``least_similarity``."""
    made = settle(firsts.withColumn("s", _sketch("cleaned")).select("id", "s.bands", "s.sketch"))
    keyed = made.select("id", F.explode("bands").alias("bucket"))
    met = salted_join(keyed.withColumnRenamed("id", "a"), keyed.withColumnRenamed("id", "b"), "bucket", part_rows=5_000, spread=True).where("a < b").select("a", "b").distinct()
    side = lambda n: made.select(F.col("id").alias(n), F.col("sketch").alias(f"_{n}"))
    differing = sum((F.bit_count(F.get("_a", F.lit(k)).bitwiseXOR(F.get("_b", F.lit(k)))) for k in range(BITS // 64)), F.lit(0))
    return spread_join(spread_join(met, side("a"), "a"), side("b"), "b").where(differing <= most_differing(least_similarity)).select("a", "b")


def near_records(rows: DataFrame, key: str = "record_id", entry: str = "row_id", least_similarity: float = 0.4, least_evidence: float | None = 5.0) -> DataFrame:
    """(id, group) of records in groups of two or more entries of one thing; the group is its least id.

    Records need IDENTITY and CONTEXT columns; any may be null, other columns are ignored. Records without number, name
    and hull are in no group. Records of one ``entry`` id are one thing, and so are those whose fields are all equal, of
    which only the first meets others. Candidates share a band and have sketches of ``least_similarity``; pairs of which
    one record has no name have too little to be sketched and share one of lone_keys() instead. Candidates are
    compared field by field and linked at ``least_evidence`` (None: all are linked). Groups are the connected components.
    """
    rows = require(rows, key, entry, *FIELDS)
    own = settle(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(entry).alias("_entry"), _cleaned(F.struct(*FIELDS)).alias("cleaned")))
    able = own.where(F.exists(F.slice("cleaned", 1, len(IDENTITY)), lambda v: v != ""))
    firsts = settle(able.groupBy("cleaned").agg(F.min("id").alias("id")))
    cand = sketched_pairs(firsts, least_similarity)
    nameless = F.get("cleaned", F.lit(IDENTITY.index("vessel_name"))) == ""
    if not firsts.where(nameless).isEmpty():
        lone = settle(firsts.select("id", nameless.alias("nameless"), F.explode(_lone("cleaned")).alias("bucket")))
        x, y = lone.where("nameless").select(F.col("id").alias("x"), "bucket"), lone.select(F.col("id").alias("y"), "bucket")
        met = salted_join(x, y, "bucket", part_rows=5_000, spread=True).where("x <> y")
        cand = cand.union(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()

    @F.pandas_udf(T.BooleanType())
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_thing(dict(zip(FIELDS, p, strict=True)), dict(zip(FIELDS, q, strict=True))) >= least_evidence for p, q in zip(a, b, strict=True)], dtype=bool)

    links = cand
    if least_evidence is not None:
        side = lambda n: firsts.select(F.col("id").alias(n), F.col("cleaned").alias(f"_{n}"))
        links = spread_join(spread_join(cand, side("a"), "a"), side("b"), "b").where(linked("_a", "_b")).select("a", "b")

    def repeats(df: DataFrame, by: str) -> DataFrame:
        """Links from each row to the first of those with the same value."""
        first = df.groupBy(by).agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return skew_join(df.select("id", by), first, by, spread=True).where("id <> a").select("a", F.col("id").alias("b"))

    return components(links.union(repeats(own.where(F.col("_entry").isNotNull()), "_entry")).union(repeats(able, "cleaned")))


def entry_pairs(rows: DataFrame, key: str = "record_id", entry: str = "row_id") -> DataFrame:
    """(record_id_a, record_id_b), a < b: all pairs of a group whose entry ids differ."""
    members = spread_join(near_records(rows, key, entry), rows.select(F.col(key).alias("id"), F.col(entry).alias("_e")), "id")
    pairs = pairs_within(members)
    e = lambda n: rows.select(F.col(key).alias(n), F.col(entry).alias(f"_{n}"))
    both = spread_join(spread_join(pairs, e("a"), "a"), e("b"), "b").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return both.select(F.col("a").alias("record_id_a"), F.col("b").alias("record_id_b")).distinct()
