import random

import numpy as np

from fairlead.llm import leak
from fairlead.llm.leak import Reader, Text, compare, fewest_edits, find_leaks, leaked, longest_run, words_of

RNG = random.Random(5)
LEX = ["".join(RNG.choice("abcdefghijkl") for _ in range(5)) for _ in range(300)]


def text(n):
    return [RNG.choice(LEX) for _ in range(n)]


def slow_edits(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edits_and_runs_equal_plain_ones():
    for _ in range(60):
        p = [RNG.choice("abc") for _ in range(RNG.randint(1, 70))]
        t = [RNG.choice("abc") for _ in range(RNG.randint(0, 90))]
        assert fewest_edits(p, t) == slow_edits(p, t)
        best = max([0, *[k for k in range(1, len(p) + 1) for a in range(len(p) - k + 1) for b in range(len(t) - k + 1) if p[a : a + k] == t[b : b + k]]]) if len(p) < 15 else None
        for cells in (0, 1 << 22):
            assert best is None or longest_run(np.array(p, object), np.array(t, object), cells) == best


def test_words():
    assert words_of("The <b>Soot-black</b> KETTLE&nbsp;isn't\n“ＦＵＬＬ” а1") == ["the", "soot", "black", "kettle", "isnt", "full", "a1"]


def make_cases():
    items = {k: text(RNG.randint(36, 70)) for k in range(12)}
    docs = {}
    for k, w in items.items():
        docs[len(docs)] = text(30) + w + text(20)
        for limit in (len(w) // 6, len(w) // 6 + 4):
            changed = list(w)
            for at in sorted(RNG.sample(range(len(w)), limit), reverse=True):
                kind = RNG.randint(0, 2)
                if kind == 0:
                    changed[at] = "zzz"
                elif kind == 1:
                    del changed[at]
                else:
                    changed.insert(at, "qqq")
            docs[len(docs)] = text(10) + changed + text(10)
        for n in (14, 15):
            a = RNG.randint(0, len(w) - n)
            docs[len(docs)] = text(20) + ["xxx"] + w[a : a + n] + ["yyy"] + text(20)
        loose = list(w)
        RNG.shuffle(loose)
        docs[len(docs)] = loose
    return items, docs


def truth(items, docs):
    """Brute force: every document against every item, word by word."""
    return {(d, i) for d, t in docs.items() for i, w in items.items() if slow_edits(w, t) * 6 <= len(w) or longest_run(np.array(w, object), np.array(t, object)) >= 15}


def frames(spark, items, docs):
    d = spark.createDataFrame([*docs.items(), (900, None), (901, ""), (None, "x y z")], "doc_id long, text string")
    i = spark.createDataFrame([*items.items(), (77, None), (78, ""), (79, "!!")], "item_id long, text string")
    return d, i


def test_operator_equals_brute_force(spark):
    items, docs = make_cases()
    d, i = frames(spark, {k: " ".join(w) for k, w in items.items()}, {k: " ".join(t).upper().replace(" ", "\u00a0", 3) for k, t in docs.items()})
    i = i.unionByName(i.where("item_id = 0"))  # a repeated row
    d = d.withColumn("item_id", d.doc_id).withColumn("key", d.text)  # extra columns with clashing names
    assert {tuple(r) for r in leaked(find_leaks(d, i)).collect()} == truth(items, docs)
    assert find_leaks(d.limit(0), i).count() == 0 and find_leaks(d, i.limit(0)).count() == 0


def test_short_items_and_numbers_equal_brute_force(spark):
    rng = random.Random(11)
    lex = LEX[:40] + ["two", "9", "seventeen", "1998", "of", "the"]
    items = {k: [rng.choice(lex) for _ in range(n)] for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 13, 17, 18, 23, 24, 30, 36])}
    items[90] = ["what", "is", "2", "2"]
    items[91] = ["who", "wrote", "hamlet"]
    items[92] = ["dull"] * 14
    docs = {}
    for w in items.values():
        for _ in range(3):
            changed = list(w)
            for at in sorted(rng.sample(range(len(w)), len(w) // 6), reverse=True):
                changed[at : at + 1] = rng.choice([[], ["zzz"], [changed[at], "4"]])
            docs[len(docs)] = [rng.choice(lex) for _ in range(12)] + ["8"] * rng.randint(0, 1) + changed + [rng.choice(lex) for _ in range(5)]
    d, i = frames(spark, {k: " ".join(w) for k, w in items.items()}, {k: " ".join(t) for k, t in docs.items()})
    assert {tuple(r) for r in leaked(find_leaks(d, i)).collect()} == truth(items, docs)


def test_results_do_not_depend_on_the_other_items(spark):
    items, docs = make_cases()
    d, i = frames(spark, {k: " ".join(w) for k, w in items.items()}, {k: " ".join(t) for k, t in docs.items()})
    whole = {tuple(r) for r in find_leaks(d, i).collect()}
    halves = {tuple(r) for h in ("item_id % 2 = 0", "item_id % 2 = 1") for r in find_leaks(d, i.where(h)).collect()}
    assert whole == halves


def test_candidates_beyond_the_broadcast(spark, monkeypatch):
    items, docs = make_cases()
    d, i = frames(spark, {k: " ".join(w) for k, w in items.items()}, {k: " ".join(t) for k, t in docs.items()})
    monkeypatch.setattr(leak, "MOST_HELD_IDS", 3)
    assert {tuple(r) for r in leaked(find_leaks(d, i)).collect()} == truth(items, docs)


STORY = "By noon the cook had sold {a} barrels to {p} and {a} casks to the smith who paid {b} coins to {p} for all but {c} of them before the first frost of the year came over the hills where {q} lived with {d} goats and waited for {p} to come back"


def test_reparameterised_items(spark):
    fill = lambda a, b, c, d, p, q: STORY.format(a=a, b=b, c=c, d=d, p=p, q=q)
    item = fill("nineteen", "40", "seven", "3", "Anders", "Old Sten")
    docs = {
        1: "Something else. " + fill("thirty one", "1,100", "2", "twelve", "Mary Anne", "Bo") + ". The end.",  # every slot has another value, throughout
        2: fill("61", "5", "9", "eight", "Olga", "Ivan").replace("61 casks", "62 casks"),  # one number for two
        3: fill("61", "5", "9", "eight", "Olga", "Ivan").replace("for Olga to", "for Petra to"),  # one name for two
        4: " ".join(random.Random(3).sample(fill("61", "5", "9", "eight", "Olga", "Ivan").split(), 50)),
    }
    d, i = frames(spark, {1: item}, docs)
    assert [(r.doc_id, r.item_id, r.kind) for r in find_leaks(d, i).collect()] == [(1, 1, "reparameterised")]
    assert leaked(find_leaks(d, i)).count() == 0


def test_recall_of_reparameterised_items(spark):
    rng = random.Random(8)
    names = ["Anders", "Bertil", "Cecilia", "Dora Lind", "Edvin", "Fritz af Geijer"]
    docs, items = {}, {}
    for k in range(20):
        body = [rng.choice(LEX) for _ in range(45)]
        slots = {at: rng.choice("nnp") for at in rng.sample(range(3, 44), 6)}
        value = lambda kind: str(rng.randint(2, 9999)) if kind == "n" else rng.choice(names)
        for out, at in ((items, k), (docs, k)):
            used = {p: value(kind) for p, kind in slots.items()}
            out[at] = " ".join(used.get(p, w) for p, w in enumerate(body))
    d, i = frames(spark, items, docs)
    found = {(r.doc_id, r.item_id) for r in find_leaks(d, i).collect()}
    assert all(a == b for a, b in found) and len(found) >= 18


def test_compare_has_no_item():
    reader = Reader()
    assert compare(Text("", reader, item=True), Text("a b", reader)) is None
