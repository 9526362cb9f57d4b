import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fairlead.llm.canon import canonical, look_alike_pairs, table

SAME = [
    ("Ｔｅｓｔ　１２３", "Test 123"), ("café", "café"), ("a​b﻿c⁠", "abc"), ("non break ing space", "non break ing space"), ("Βаtсh nοte", "Batch note"),
    ("ｱｲｳ", "アイウ"), ("ﬁn ﬂow", "fin flow"), ("ẹ́", "ẹ́"), ("ё", "ë"), ("ё", "ë"), ("K Å", "K Å"), ("well‑known", "well-known"), ("a\r\nb", "a\nb"), ("한", "한"), ("o‍́", "ó"),
]
APART = [("O", "0"), ("l", "1"), ("Case", "case"), ("café", "cafe"), ("a b", "a\nb"), ("ö", "ó"), ("и", "й"), ("a–b", "a-b"), ("x²", "x2"), ("”", '"'), ("а ", "a"), ("中", "虫")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    assert canonical(a) == canonical(b)


@pytest.mark.parametrize("a,b", APART)
def test_apart(a, b):
    assert canonical(a) != canonical(b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0xFFFF, exclude_categories=["Cs"]), max_size=30))
def test_form_is_fixed(text):
    form = canonical(text)
    assert canonical(form) == form and canonical(unicodedata.normalize("NFD", text)) == form and canonical(unicodedata.normalize("NFC", text)) == form


def test_table_is_closed():
    forms = table()
    assert not [t for t in forms.values() if any(c in forms for c in t)] and canonical(None) is None and canonical("") == ""


def test_pairs(spark):
    rows = [(1, "abc"), (2, "а​bc"), (3, "abc"), (4, "Abc"), (5, None), (6, ""), (7, "​"), (None, "abc"), (8, "abc\n"), (1, "abc")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, form string")
    assert {tuple(r) for r in look_alike_pairs(docs).collect()} == {(1, 2), (2, 3), (6, 7)}
    assert look_alike_pairs(docs.limit(0)).count() == 0


def test_hot_class(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot text' else concat('t', id) end as text")
    odd = spark.createDataFrame([(1000, "hot text")], "doc_id long, text string")
    assert look_alike_pairs(docs.unionByName(odd)).count() == 134
