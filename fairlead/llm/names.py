"""Variant spellings of organisations, attributed through a noisy channel.

Canonical forms are the listed tags and every other full form that is spelled the same way more often than misspellings
of any form could explain. A typed name is attributed to the canonical form of the greatest posterior: the frequency of
the form times the likelihood that typing it yields the name by typos, abbreviation, cuts, reordering or initials. How
often slips and cuts of a head occur is estimated from the mentions. Names meet canonical forms through keys (deletion
neighbourhoods of word beginnings, word ends, initials), never pairwise.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.llm.canon import canonical
from fairlead.operators.skew import salted_join
from fairlead.schema import require
from fairlead.session import settle

# Forms of companies, which say nothing of the name.
LEGAL = frozenset("ltd limited pte llc inc gmbh kk nv sa as co corp plc bv ab ag oy asa pty srl spa".split())
LETTERS = str.maketrans({"ø": "o", "đ": "d", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i"})
#: Costs are negative log-likelihoods of one operation of the channel.
TYPO, CUT, ABBREVIATED, INITIAL, MISSING, EXTRA, JOINED, MOVED, INITIALS, COMPANY, MOST = 3.0, 3.0, 1.0, 1.5, 1.0, 7.0, 1.5, 0.7, 3.5, 0.2, 9.0


def fold(text: str) -> str:
    """Case and accents aside."""
    text = unicodedata.normalize("NFKD", canonical(text).casefold().translate(LETTERS))
    return "".join(c for c in text if not unicodedata.combining(c)).translate(LETTERS)


def tokens_of(text: str) -> tuple[str, ...]:
    """Words of a name: brackets gone, dotted or slashed letters joined ('S.S.' is 'ss'), apostrophes dropped."""
    bare = re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", fold(text))
    bare = re.sub(r"\b(\w)/(\w)\b", r"\1\2", bare)
    bare = re.sub(r"\b((?:\w\.){2,}\w?)", lambda m: m.group().replace(".", ""), bare)
    bare = re.sub(r"['’`´]", "", bare)
    return tuple(re.findall(r"[^\W_]+", bare))


def plain_of(words: tuple[str, ...]) -> tuple[str, ...]:
    """Without forms of companies at the end."""
    end = len(words)
    while end > 1 and words[end - 1] in LEGAL:
        end -= 1
    return words[:end]


@lru_cache(maxsize=200_000)
def distance(a: str, b: str) -> int:
    """Optimal string alignment distance: changed, dropped, added or swapped letters; 3 means three or more."""
    if abs(len(a) - len(b)) > 2:
        return 3
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if min(row) > 2:
            return 3
        before, last = last, row
    return min(last[-1], 3)


def _within(short: str, word: str) -> bool:
    """Whether short's letters occur in word in order, first letter first."""
    rest = iter(word)
    return short[:1] == word[:1] and all(c in rest for c in short)


@lru_cache(maxsize=200_000)
def head_cost(typed: str, head: str) -> float:
    if typed == head:
        return 0.0
    if 4 <= len(typed) < len(head) - 1 and head.startswith(typed):
        return CUT
    far = distance(typed, head)
    if far == 1 and len(head) >= 4 or far == 2 and len(head) >= 8:
        return TYPO * far
    if 4 <= len(typed) < len(head):
        if len(typed) >= 5 and min(distance(typed, head[: len(typed) + k]) for k in (-1, 0, 1)) == 1:
            return CUT + TYPO + 1
    return MOST + 1


@lru_cache(maxsize=200_000)
def tail_cost(typed: str, word: str) -> float:
    if typed == word:
        return 0.0
    if len(typed) == 1 and word.startswith(typed):
        return INITIAL
    if len(typed) >= 2 and len(typed) < len(word) and _within(typed, word):
        return TYPO - 1 if len(word) - len(typed) == 1 and len(word) > 5 else ABBREVIATED
    if len(typed) >= 4 and distance(typed, word) == 1:
        return TYPO
    if len(typed) >= 4 and len(word) - len(typed) >= 2 and min(distance(typed, word[: len(typed) + k]) for k in (-1, 0, 1)) == 1:
        return TYPO + ABBREVIATED
    return MOST + 1


def _tail(rest: tuple[str, ...], tail: tuple[str, ...]) -> float:
    """Cheapest alignment in order of the typed rest with the canonical tail."""
    row = [MISSING * j for j in range(len(tail) + 1)]
    for k, typed in enumerate(rest):
        extra = COMPANY if typed in LEGAL or typed == "of" else 0.7 if typed == "group" else EXTRA
        new = [row[0] + extra]
        for j, word in enumerate(tail, 1):
            best = min(row[j] + extra, new[j - 1] + MISSING, row[j - 1] + tail_cost(typed, word))
            new.append(best)
        if k and len(rest) > 1:  # a word split in two
            glued = rest[k - 1] + typed
            for j, word in enumerate(tail, 1):
                if glued == word:
                    new[j] = min(new[j], before[j - 1] + JOINED)
        before, row = row, new
    return row[-1]


def cost(typed: tuple[str, ...], form: tuple[str, ...]) -> float:
    """Negative log-likelihood of typing ``typed`` for the canonical ``form``; over MOST: it can't be."""
    if not typed or not form:
        return MOST + 1
    best, head, tail = MOST + 1, form[0], form[1:]
    bare = plain_of(typed)
    if typed == form or bare == form:
        return 0.0 if typed == form else COMPANY
    if len(bare) == 1 and len(form) > 1 and bare[0] == "".join(w[0] for w in form):
        best = INITIALS + (len(form) == 2)
    for i in range(len(typed)):
        for glued in (1, 2):
            if i + glued > len(typed):
                break
            start = head_cost("".join(typed[i : i + glued]), head) + JOINED * (glued - 1)
            if start >= best:
                continue
            # The words before the head come after the form's tail if the name is turned round.
            before, after = typed[:i], typed[i + glued :]
            best = min(best, start + _tail(after + before, tail) + (MOVED if before else 0), start + _tail(before + after, tail) + (MOVED if before else 0))
    return best


def _neighbours(word: str) -> set[str]:
    """Keys of a word: what head_cost() allows shares one. A slip lies in the first five letters or behind them, a second
    one leaves either these with one slip or the end as it is; words of one or two letters allow none."""
    stem = word[:5]
    out = {stem, word[:4]}
    if len(word) >= 3:
        out.update(stem[:k] + stem[k + 1 :] for k in range(len(stem)))
    if len(word) >= 6:
        out.add("$" + word[-3:])
    return out


def keys_of_form(form: tuple[str, ...]) -> list[str]:
    return sorted(_neighbours(form[0]) | {"#" + "".join(w[0] for w in form)}) if form else []


def keys_of_name(typed: tuple[str, ...]) -> list[str]:
    glued = [a + b for a, b in zip(typed, typed[1:])]
    bare = plain_of(typed)
    out = {"#" + bare[0]} if len(bare) == 1 else set()
    return sorted(out.union(*(_neighbours(w) for w in [*typed, *glued])))


_NAME = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("plain", T.StringType()), T.StructField("form_keys", T.ArrayType(T.StringType())), T.StructField("name_keys", T.ArrayType(T.StringType()))])


@F.pandas_udf(_NAME)
def _parse(names: pd.Series) -> pd.DataFrame:
    rows = []
    for n in names:
        words = tokens_of(n) if isinstance(n, str) else ()
        rows.append((list(words), " ".join(plain_of(words)), keys_of_form(words), keys_of_name(words)))
    return pd.DataFrame(rows, columns=["tokens", "plain", "form_keys", "name_keys"])


@F.pandas_udf(T.DoubleType())
def _cost(typed: pd.Series, forms: pd.Series) -> pd.Series:
    return pd.Series([cost(tuple(a), tuple(b)) for a, b in zip(typed, forms, strict=True)])


#: Organisations named together are parted by a slash, an ampersand, a semicolon or 'and'; 'S/B' is one word.
def parts_of(c: Column) -> Column:
    kept = F.regexp_replace(c, r"\b(\p{L})/(\p{L})\b", "$1$2")
    return F.filter(F.transform(F.split(kept, r"(?i)\s+(?:&|and)\s+|\s*[/&;]\s*"), lambda x: F.btrim(x)), lambda x: x != "")


def attribute(mentions: DataFrame, listed: DataFrame, least: int = 4, slack: float = 2.0, cited: float = 0.0, placed: float = 0.0) -> DataFrame:
    """(mention, tag) of typed names and the listed organisations that they mean.

    mentions: mention, field, text, country, source (the row's country and its reference; may be null). listed: field,
    tag, tag_country, tag_source. A full form that is not listed becomes a rival canonical form if it is typed at least
    ``least`` times and more than ``slack`` times as often as a slip, or a cut, of the listed form it might be usually is.
    The name alone decides; ``cited`` and ``placed`` are log-odds by which the row's source and country may weigh in, off
    by default. A text naming several organisations may yield several tags; null and blank texts yield none. Texts equal
    to a tag yield it too.
    """
    said = require(mentions, "mention", "field", "text", "country", "source").where(F.btrim("text") != "")
    said = said.select("mention", "field", "text", *[F.coalesce(F.btrim(c), F.lit("")).alias(c) for c in ("country", "source")])
    texts = said.groupBy("field", "text").agg(F.count(F.lit(1)).alias("times")).withColumn("parts", parts_of(F.col("text")))
    named = texts.select("field", "text", "times", (F.size("parts") == 1).alias("alone"), F.explode("parts").alias("part"))
    # Each distinct part is parsed once.
    parsed = settle(named.groupBy("field", "part").agg(F.sum("times").alias("times")).withColumn("p", _parse("part")).select("field", "part", "times", "p.*"))
    often = parsed.groupBy("field", "plain").agg(F.sum("times").alias("n"))

    tags = require(listed, "field", "tag", "tag_country", "tag_source").where(F.btrim("tag") != "").dropDuplicates(["field", "tag"])
    tags = tags.withColumn("p", _parse("tag")).select("field", "tag", "tag_country", "tag_source", F.col("p.tokens").alias("form"), F.array_join("p.tokens", " ").alias("plain"), F.col("p.form_keys").alias("keys"))
    tags = tags.join(often, ["field", "plain"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    tails = tags.select("field", F.array_join(F.slice("form", F.lit(2), F.greatest(F.size("form") - 1, F.lit(1))), " ").alias("tail")).where("tail <> ''").distinct()

    # Full forms that aren't listed: a head and a known tail. What share of a form's mentions a slip or a cut of its head
    # usually gets is taken from those that are rarer than the form; what is more frequent than that stands for itself.
    full = parsed.select("field", "plain", F.array_join(F.slice(F.split("plain", " "), F.lit(2), F.greatest(F.size(F.split("plain", " ")) - 1, F.lit(1))), " ").alias("tail")).distinct()
    full = full.join(tails, ["field", "tail"], "left_semi").join(often, ["field", "plain"]).join(tags.select("field", "plain"), ["field", "plain"], "left_anti")
    full = settle(full.withColumn("p", _parse("plain")).select("field", "plain", "n", F.col("p.tokens").alias("form"), F.col("p.form_keys").alias("keys")))
    slips = full.select("field", "plain", "n", F.col("form").alias("u"), F.explode("keys").alias("key")).join(tags.select("field", F.col("form"), F.col("n").alias("of"), F.explode("keys").alias("key")), ["field", "key"])
    slips = slips.select("field", "plain", "n", "u", "form", "of").distinct().where(F.slice("u", F.lit(2), F.size("u")) == F.slice("form", F.lit(2), F.size("form")))
    slips = settle(slips.where(_cost("u", "form") <= max(TYPO, CUT) + COMPANY).select("field", "plain", "n", "of", F.startswith(F.get("form", F.lit(0)), F.get("u", F.lit(0))).alias("cut")))
    usual = {r.cut: r.share for r in slips.where("n < of").groupBy("cut").agg((F.sum("n") / F.sum("of")).alias("share")).collect()}
    # A listed form whose head is not written as it is yields to one whose head is, by what a slip's share says beyond TYPO.
    # Rivals yield by as much, so they stand to such forms as before.
    inexact = max(0.0, -math.log(usual[False]) - TYPO) if usual.get(False) else 0.0
    share = F.when(F.col("cut"), usual.get(True, 0.0)).otherwise(usual.get(False, 0.0))
    slips = slips.where(F.col("n") < least + F.col("of") * share * slack).select("field", "plain").distinct()
    rivals = full.where(F.col("n") >= least).join(slips, ["field", "plain"], "left_anti").select("field", F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("tag_country"), F.lit(None).cast("string").alias("tag_source"), "form", "keys", "n")
    forms = settle(tags.select(*rivals.columns).unionByName(rivals))

    own = lambda c: F.transform(F.col(c), lambda k: F.concat_ws("\u0001", F.col("field"), k))
    near = salted_join(parsed.select("field", "part", "tokens", F.explode(own("name_keys")).alias("key")), forms.select("tag", "tag_country", "tag_source", "form", "n", F.explode(own("keys")).alias("key")), "key")
    near = settle(near.drop("key").distinct().withColumn("cost", _cost("tokens", "form")).where(F.col("cost") <= MOST).withColumn("exact", F.col("tag").isNotNull() & F.array_contains("tokens", F.get("form", F.lit(0)))).drop("tokens"))

    # Rows of one name may say different countries; each distinct saying is judged once, and only then meets its rows.
    whole = F.concat_ws("\u0001", "field", "text", "country", "source")
    said = said.withColumn("_k", whole)
    sayings = said.groupBy("field", "text", "country", "source").agg(F.first("_k").alias("_k"))
    saying = salted_join(sayings.withColumn("_t", F.concat_ws("\u0001", "field", "text")), named.select(F.concat_ws("\u0001", "field", "text").alias("_t"), "part", "alone"), "_t").drop("_t")
    judged = saying.select("field", "part", "country", "source", "alone").distinct().join(near, ["field", "part"])
    known = (F.col("country") != "") & (F.lower("country") != "unknown") & (F.col("tag_country") != "") & (F.col("tag_country") != "AMBIGUOUS")
    sourced = (F.col("source") != "") & (F.col("tag_source") != "")
    fits = F.when(sourced, F.when(F.instr("source", F.col("tag_source")) > 0, cited).when(F.col("alone"), -cited).otherwise(0.0)).otherwise(0.0)
    fits = fits + F.when(known, F.when(F.lower("country") == F.lower("tag_country"), placed).when(F.col("alone"), -2 * placed).otherwise(0.0)).otherwise(0.0)
    post = judged.withColumn("post", F.log(F.col("n") + 0.5) - F.col("cost") - F.when(F.col("exact"), 0.0).otherwise(inexact) + F.coalesce(fits, F.lit(0.0)))
    best = post.groupBy("field", "part", "country", "source", "alone").agg(F.max(F.struct("post", F.negative("cost").alias("close"), F.array_join("form", " ").alias("name"), "tag")).alias("b"))
    best = best.where(F.col("b.tag").isNotNull()).select("field", "part", "country", "source", "alone", F.col("b.tag").alias("tag"))
    tags_of = saying.join(best, ["field", "part", "country", "source", "alone"]).select("_k", "tag").distinct()
    return salted_join(said.select("mention", "field", "_k"), tags_of, "_k").select("mention", "field", "tag").distinct()
