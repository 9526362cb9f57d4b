"""Evaluation items that leak into documents.

Texts are brought to one form, cut into words and turned into templates, word by word, by what a word is and not by
lists of the items: what begins with a digit or is an English number word becomes <num>, the word after a number <unit>
unless it is a function word, and in a second template a capitalised word inside a sentence <name>, runs of one
placeholder counting once. Windows of up to four template words of every item are hashed and joined with those of the
documents, of which a Bloom filter of fixed size lets only likely ones pass the scan.

The first template has one word for each word of the text, so the q-gram lemma holds for it: a text that holds an item
with at most k changed words keeps all but a known number of its windows, and 15 words in a row keep a known number too.
A (document, item) with fewer common windows is no case; all others are compared word by word. The second template finds
items with other numbers and names: a document in which it recurs is reported if every slot value of the item stands for
one value of the document throughout (the slots are consistent), and left out otherwise.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm.canon import canonical
from fairlead.operators.skew import skew_join
from fairlead.schema import require
from fairlead.session import settle

# English number words, and function words, which are no units.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half".split()
)
FUNCTION_WORDS = frozenset(
    "a an the and or but nor of to in on at by for from with without as than that this these those which who whom whose "
    "what when where why how is are was were be been being has have had do does did will would shall should can could may "
    "might must not no so if then it its he she they we you i his her their our your my him them us me".split()
)
MARKUP = re.compile(r"<[^<>]{1,200}>|&[a-z]{2,8};|&#\d{1,6};", re.IGNORECASE)
#: Words, and the marks after which a capital is no sign of a name.
TOKEN = re.compile(r"[^\W_]+|[.!?:;\n]")
WINDOW = 4
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
NUM_HASH, UNIT_HASH, NAME_HASH = (np.uint64(xxhash.xxh3_64_intdigest(p)) for p in (NUM, UNIT, NAME))
#: Bits of the Bloom filter: 16 for each window of an item, between these bounds (16 MB at most).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Candidate documents are picked from the corpus by a broadcast of their ids up to so many (16 MB), else by a join.
MOST_HELD_IDS = 2_000_000


def tokens_in(text: str) -> list[str]:
    """Words as written and sentence marks, in one form: markup and disguised characters leave no trace."""
    bare = canonical(text)
    if "<" in bare or "&" in bare:
        bare = MARKUP.sub(" ", bare)
    return TOKEN.findall(bare.replace("'", "").replace("’", ""))


def words_of(text: str) -> list[str]:
    """Words in one form: markup, punctuation, case, line breaks and disguised characters leave no trace."""
    return [t.casefold() for t in tokens_in(text) if t not in ".!?:;\n"]


class Reader:
    """Turns texts into templates; remembers what it found out about each distinct token."""

    MOST = 400_000

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.hash = np.zeros(1 << 12, np.uint64)
        self.flags = np.zeros((4, 1 << 12), bool)  # mark, number, function word, capital

    def _add(self, token: str) -> int:
        k = self.memo[token] = len(self.memo)
        if k == len(self.hash):
            self.hash = np.concatenate([self.hash, np.zeros_like(self.hash)])
            self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)], 1)
        word = token.casefold()
        self.hash[k] = xxhash.xxh3_64_intdigest(word)
        self.flags[:, k] = token in ".!?:;\n", word[0].isdigit() or word in NUMBERS, word in FUNCTION_WORDS, token[0].isupper()
        return k

    def codes(self, tokens: list[str]) -> np.ndarray:
        if len(self.memo) > self.MOST:
            self._clear()
        get = self.memo.get
        return np.array([self._add(t) if (k := get(t)) is None else k for t in tokens], np.intp)

    def templates(self, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of texts end to end, ``first`` at their first tokens: which tokens are words, and of these the hash as
        written, the hash in the first template and the kind: 0 a word, 1 number, 2 unit, 3 name."""
        mark, number, function, capital = self.flags[:, at]
        begins = first.copy()
        begins[1:] |= mark[:-1]
        keep = ~mark
        opens = np.cumsum(first)[keep]  # the text of each word
        plain, number, function, capital, begins = self.hash[at][keep], number[keep], function[keep], capital[keep], begins[keep]
        unit = np.zeros(len(plain), bool)
        unit[1:] = number[:-1] & (opens[1:] == opens[:-1])
        unit &= ~number & ~function
        name = capital & ~begins & ~number & ~unit & ~function
        kinds = np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0))).astype(np.uint8)
        return keep, plain, np.where(number, NUM_HASH, np.where(unit, UNIT_HASH, plain)), kinds

    def read(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The words of one text, and of each what templates() says."""
        tokens = tokens_in(text)
        first = np.zeros(len(tokens), bool)
        first[:1] = True
        keep, plain, hashes, kinds = self.templates(self.codes(tokens), first)
        return [t.casefold() for t, k in zip(tokens, keep, strict=True) if k], plain, hashes, kinds


def windows(hashes: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """A key for each window of ``size`` template words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    key = np.full(n, size * 2 + family, np.uint64)
    for k in range(size):
        key = (key ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def collapsed(hashes: np.ndarray, kinds: np.ndarray, opens: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The second template: names are placeholders too and runs of one count once. Its hashes and where each begins.

    ``opens``: the text of each word, where texts stand end to end.
    """
    h = np.where(kinds == 3, NAME_HASH, hashes)
    first = np.ones(len(h), bool)
    first[1:] = (kinds[1:] == 0) | (h[1:] != h[:-1])
    if opens is not None:
        first[1:] |= opens[1:] != opens[:-1]
    at = np.flatnonzero(first)
    return h[at], at


def plan(words: list[str], hashes: np.ndarray, kinds: np.ndarray, literal: np.ndarray, run: int, one_in: int) -> list[tuple[int, int, np.ndarray, int]]:
    """(family, window size, distinct keys, least common ones) by which an item is looked for.

    An edit changes one template word and may change whether the next one is a unit, so it touches size + 1 windows; what
    stands before the item in a document may change its first word. Sizes go down until some window must be left; single
    words are compared without placeholders, so nothing but the edit touches them.
    """
    n, edits = len(words), len(words) // one_in
    for size in range(WINDOW, 0, -1):
        touched = (size + 1) * edits + 1 if size > 1 else edits
        if n - size + 1 - touched >= 1:
            break
    keys = windows(hashes, size) if size > 1 else windows(literal, 1)
    distinct = np.unique(keys)
    least = max(1, len(distinct) - touched)
    for a in range(n - run + 1):  # the fewest that any run of ``run`` words leaves, its first word aside
        least = min(least, len(np.unique(keys[a + (size > 1) : a + run - size + 1])))
    out = [(0, size, distinct, least)]
    h, _ = collapsed(hashes, kinds)
    if len(h) >= WINDOW and (kinds > 0).any():
        distinct = np.unique(windows(h, WINDOW, 1))
        out.append((1, WINDOW, distinct, max(1, len(distinct) - (WINDOW + 1) * (len(h) // one_in) - 1)))
    return out


def fewest_edits(pattern: list, text: list) -> int:
    """Least number of words changed, dropped or added to find pattern somewhere in text; bit-parallel over the pattern."""
    return best_place(pattern, text)[0]


def best_place(pattern: list, text: list) -> tuple[int, int]:
    """fewest_edits() and the number of words of text after which it is first reached."""
    where: dict = {}
    for k, x in enumerate(pattern):
        where[x] = where.get(x, 0) | 1 << k
    full, high = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, now = full, 0, len(pattern)
    best, place = now, 0
    for at, x in enumerate(text, 1):
        eq = where.get(x, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (~(across | up) & full), up & across
        now += bool(plus & high) - bool(minus & high)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (~(vertical | plus) & full), plus & vertical
        if now < best:
            best, place = now, at
    return best, place


def longest_run(pattern: np.ndarray, text: np.ndarray, most_cells: int = 1 << 22) -> int:
    """The most words in a row that both hold: along the diagonals of the grid of equal words, or row by row of a grid of more cells."""
    m, n = len(pattern), len(text)
    if not m or not n:
        return 0
    if m * n > most_cells:
        best, run = 0, np.zeros(n + 1, np.int64)
        for x in pattern:
            run[1:] = np.where(text == x, run[:-1] + 1, 0)
            best = max(best, int(run.max()))
        return best
    grid = np.zeros((m, n + m), bool)
    grid[:, :n] = pattern[::-1, None] == text[None, :]
    flat = np.zeros((n + m - 1, m + 1), bool)  # one cell less in a row moves each row one on: diagonals become columns
    flat[:, :m] = grid.ravel()[: m * (n + m - 1)].reshape(m, n + m - 1).T
    return int(np.diff(np.flatnonzero(~flat.ravel()), prepend=-1).max()) - 1


class Text:
    """A text, read: what the comparison of a document with an item needs."""

    def __init__(self, text: str, reader: Reader, run: int = 15, one_in: int = 6, item: bool = False):
        self.words, self.plain, self.hashes, self.kinds = reader.read(text)
        h, at = collapsed(self.hashes, self.kinds)
        self.tokens, self.at = h.tolist(), at.tolist()
        self.plans = plan(self.words, self.hashes, self.kinds, self.plain, run, one_in) if item and self.words else []
        self.runs = frozenset(windows(self.plain, run).tolist())
        self._made: dict = {}

    def keys(self, size: int) -> np.ndarray:
        """The windows of the first template, in order."""
        if size not in self._made:
            self._made[size] = windows(self.hashes if size > 1 else self.plain, size)
        return self._made[size]

    def value(self, k: int) -> tuple[str, ...]:
        """The words that the k-th token of the second template stands for."""
        return tuple(self.words[self.at[k] : self.at[k + 1] if k + 1 < len(self.at) else len(self.words)])


def stretches(item: Text, doc: Text, one_in: int) -> list[tuple[int, int]]:
    """Where in the document the item can be: around the windows that they share."""
    if not item.plans:
        return []
    _, size, keys, _ = item.plans[0]
    made = doc.keys(size)
    if not len(made):
        return []
    near = len(item.words) + len(item.words) // one_in + size
    out: list[list[int]] = []
    for p in np.flatnonzero(keys[np.minimum(np.searchsorted(keys, made), len(keys) - 1)] == made):
        if out and p - near <= out[-1][1]:
            out[-1][1] = int(p) + near
        else:
            out.append([max(0, int(p) - near), int(p) + near])
    return [(a, b) for a, b in out]


def consistent(item: Text, doc: Text, end: int) -> bool:
    """Whether each slot value of the item stands for one value of the document, where the templates align before token ``end``."""
    begin = max(0, end - len(item.tokens) - len(item.tokens) // 3)
    seen: dict[tuple, tuple] = {}
    for a, b, n in SequenceMatcher(None, item.tokens, doc.tokens[begin:end], autojunk=False).get_matching_blocks():
        for k in range(n):
            kind = int(item.kinds[item.at[a + k]])
            if kind in (1, 3) and seen.setdefault((kind, item.value(a + k)), v := doc.value(begin + b + k)) != v:
                return False
    return True


def compare(item: Text, doc: Text, run: int = 15, one_in: int = 6) -> tuple[str, int, int] | None:
    """(kind, longest run, fewest edits) of a document that holds an item, else None. The item's Text is made as one."""
    mine = item.words
    if not mine:
        return None
    places = stretches(item, doc, one_in)
    edits = min((fewest_edits(mine, doc.words[a:b]) for a, b in places), default=len(mine))
    longest = lambda: max((longest_run(item.plain, doc.plain[a:b]) for a, b in places), default=0)
    if edits * one_in <= len(mine):
        return "whole", longest(), edits
    if not item.runs.isdisjoint(doc.runs):
        return "part", longest(), edits
    if len(item.tokens) >= WINDOW and (item.kinds > 0).any():
        off, end = best_place(item.tokens, doc.tokens)
        if off * one_in <= len(item.tokens) and consistent(item, doc, end):
            return "reparameterised", longest(), edits
    return None


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", run: int = 15, one_in: int = 6) -> DataFrame:
    """(doc_id, item_id, kind, longest_run, edits) of each document that holds an item.

    kind: whole (at most one word in ``one_in`` changed, dropped or added), part (``run`` words in a row) or
    reparameterised (neither, but the item's template with consistent slots; names count as slots where both texts
    write them with a capital). Items of any length are found; null and empty texts, and texts without a word, hold
    nothing and are in nothing. Documents are scanned once for windows and once for the texts of candidates; only the
    latter are shuffled. Of each item the windows most frequent in the documents, up to half of those that a case must
    share, are left out of the join and the bound lowered by their number, which loses nothing. What is broadcast is a
    Bloom filter of at most MOST_BITS and candidate ids up to MOST_HELD_IDS.
    """
    spark = docs.sparkSession
    docs = require(docs, key, text).where(F.col(text).isNotNull() & F.col(key).isNotNull())
    rows = require(items, item_key, item_text).where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).distinct()
    numbered = rows.select(F.col(item_key).alias("_item"), F.col(item_text).alias("_text"), F.xxhash64(item_text).alias("_version"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for batch in batches:
            out = []
            for i, v, t in zip(batch["_item"], batch["_version"], batch["_text"], strict=True):
                words, plain, hashes, kinds = reader.read(t)
                if words:
                    out += [(i, v, f, size, keys.view(np.int64).tolist(), least) for f, size, keys, least in plan(words, hashes, kinds, plain, run, one_in)]
            yield pd.DataFrame(out, columns=["_item", "_version", "family", "size", "keys", "least"])

    parsed = numbered.mapInPandas(parse, "_item bigint, _version bigint, family int, size int, keys array<bigint>, least int")
    sought = settle(parsed.select("_item", "_version", "family", "size", "least", F.explode("keys").alias("key")))
    shape = sought.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.struct("family", "size")).alias("sizes")).head()
    bits = LEAST_BITS
    while bits < min(16 * shape.n, MOST_BITS):
        bits *= 2
    probes = F.array(F.pmod("key", F.lit(bits)), F.pmod(F.shiftrightunsigned("key", 29), F.lit(bits)))
    at = sought.select(F.explode(probes).alias("at")).select(F.expr("cast(at div 64 as int)").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))
    held = at.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    filled = np.zeros(bits // 64, np.int64)
    filled[held["word"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    bloom, shapes = spark.sparkContext.broadcast(filled.view(np.uint64)), [(s.family, s.size) for s in shape.sizes]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, table = Reader(), bloom.value
        mask, six, one = np.uint64(bits - 1), np.uint64(6), np.uint64(1)
        hit = lambda at: (table[at >> six] >> (at & np.uint64(63))) & one
        for batch in batches:
            ids, tokens, sizes = [], [], []
            for last, i, t in zip(range(len(batch), 0, -1), batch[key], batch[text], strict=True):
                mine = tokens_in(t)
                if mine:
                    ids.append(i)
                    sizes.append(len(mine))
                    tokens += mine
                if not tokens or last > 1 and len(tokens) < 100_000:
                    continue
                # Many texts at once, end to end; no window reaches from one into the next.
                ends = np.cumsum(sizes)
                first = np.zeros(len(tokens), bool)
                first[np.concatenate([[0], ends[:-1]])] = True
                keep, plain, hashes, kinds = reader.templates(reader.codes(tokens), first)
                opens = (np.cumsum(first) - 1)[keep]
                for family, size in shapes:
                    if family:
                        h, at = collapsed(hashes, kinds, opens)
                        of = opens[at]
                    else:
                        h, of = plain if size == 1 else hashes, opens
                    made = windows(h, size, family)
                    good = np.flatnonzero((of[: len(made)] == of[size - 1 :]) & hit(made & mask).astype(bool) & hit(made >> np.uint64(29) & mask).astype(bool)) if len(made) else []
                    yield pd.DataFrame({"_doc": np.array(ids, np.int64)[of[good]], "key": made[good].view(np.int64)} if len(good) else {"_doc": [], "key": []})
                ids, tokens, sizes = [], [], []

    hits = settle(docs.select(F.col(key).cast("bigint").alias(key), text).mapInPandas(scan, "_doc bigint, key bigint").distinct())
    often = hits.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    common_first = W.partitionBy("_item", "_version", "family").orderBy(F.desc("often"), "key")  # the windows of one item
    kept = sought.join(often, "key").withColumn("place", F.row_number().over(common_first)).withColumn("spare", F.expr("cast(least div 2 as int)")).where("place > spare")
    met = skew_join(hits, kept.select("key", "_item", "_version", "family", (F.col("least") - F.col("spare")).alias("need")), "key")
    pairs = settle(met.groupBy("_doc", "_item", "_version", "family", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need").select("_doc", "_item", "_version").distinct())

    asked = pairs.join(numbered, ["_item", "_version"]).groupBy("_doc").agg(F.collect_list(F.struct("_item", "_text")).alias("asked"))
    ids = pairs.select(F.col("_doc").alias(key)).distinct()
    few = ids.limit(MOST_HELD_IDS + 1).count() <= MOST_HELD_IDS
    near = docs.join(F.broadcast(ids) if few else ids, key, "left_semi").select(F.col(key).cast("bigint").alias("_doc"), F.col(text).alias("_whole"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        read = lru_cache(maxsize=4096)(lambda t: Text(t, reader, run, one_in, item=True))
        for batch in batches:
            out = []
            for i, whole, asked_ in zip(batch["_doc"], batch["_whole"], batch["asked"], strict=True):
                doc = Text(whole, reader, run, one_in)
                out += [(i, a["_item"], *got) for a in asked_ if (got := compare(read(a["_text"]), doc, run, one_in))]
            yield pd.DataFrame(out, columns=[key, item_key, "kind", "longest_run", "edits"])

    return near.join(asked, "_doc").mapInPandas(verify, f"{key} bigint, {item_key} bigint, kind string, longest_run int, edits int")


def leaked(found: DataFrame) -> DataFrame:
    """(doc_id, item_id) of texts held wholly or partly, without items that recur with other numbers and names."""
    return found.where(F.col("kind") != "reparameterised").select("doc_id", "item_id").distinct()
