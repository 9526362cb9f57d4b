import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairlead.llm import packing as P
from fairlead.llm.queries import VOCABULARY


def best_fit(sizes, capacity):
    room = []
    for s in sorted(sizes, reverse=True):
        k = min((k for k, r in enumerate(room) if r >= s), key=lambda k: room[k], default=None)
        if k is None:
            room.append(capacity - s)
        else:
            room[k] -= s
    return len(room)


@pytest.mark.parametrize("kind", ["mixed", "halves", "thirds", "small", "equal", "none"])
def test_pack(kind):
    rng = np.random.default_rng(4)
    cap = 512
    sizes = {
        "mixed": rng.integers(0, cap + 1, 3000), "halves": rng.integers(200, 312, 1500), "thirds": rng.integers(120, 220, 2000), "small": rng.integers(1, 40, 4000), "equal": np.full(900, 171), "none": np.array([], np.int64),
    }[kind].astype(np.int64)
    got = P.pack(sizes, cap)
    assert len(got) == len(sizes) and (got >= 0).all()
    if len(sizes):
        load = np.bincount(got, sizes)
        assert load.max() <= cap
        assert len(load) <= best_fit(sizes.tolist(), cap) * 1.05 + 1


def test_configurations_reach_the_bound():
    plan = P.configurations([30, 34, 36], [300, 300, 300], 100)
    filled = sum(n for _, n in plan)
    assert all((np.array([30, 34, 36]) * c).sum() <= 100 for c, _ in plan) and filled <= 300


def test_documents(spark):
    if not os.path.exists(VOCABULARY):
        pytest.skip("no vocabulary here")
    docs = spark.createDataFrame([(1, "word " * 1300, "x"), (2, "short text", "x"), (3, None, "x"), (4, "", "x"), (5, "short text", "x"), (6, "<|endoftext|>", "x")], "doc_id long, text string, tokens string")
    sizes = spark.createDataFrame([(1, 512), (2, 2048), (3, None), (4, 0)], "pack_id int, capacity_tokens int")
    tokens = {r.doc_id: r.tokens for r in P.token_counts(docs, VOCABULARY).collect()}
    assert tokens[3] == tokens[4] == 0 and tokens[6] > 1
    got = P.pack_documents(docs, sizes, VOCABULARY)
    assert {(r.pack_id, r.n) for r in got.groupBy("pack_id").agg(F.countDistinct("doc_id").alias("n")).collect()} == {(1, 6), (2, 6)}
    pieces = got.where("pack_id = 1 and doc_id = 1").orderBy("piece").collect()
    assert [p.start_token for p in pieces] == [512 * k for k in range(len(pieces))] and sum(p.tokens for p in pieces) == tokens[1] and all(p.tokens == 512 for p in pieces[:-1])
    assert got.groupBy("pack_id", "container").agg(F.sum("tokens").alias("t")).where("t > if(pack_id = 1, 512, 2048)").count() == 0
    assert P.pack_documents(docs, sizes, VOCABULARY, shard_pieces=2).count() == got.count() and P.pack_documents(docs.limit(0), sizes, VOCABULARY).count() == 0 and P.pack_documents(docs, sizes.limit(0), VOCABULARY).count() == 0


def test_counts_do_not_depend_on_the_library(spark):
    other = VOCABULARY.replace(".tiktoken", ".json")
    if not os.path.exists(VOCABULARY) or not os.path.exists(other):
        pytest.skip("no vocabulary here")
    texts = ["a" * 200_000, " " * 200_000, "LNG carrier 174,000 cbm\n\n  don't", "naïve 船 \u200b<|endoftext|>", "\t\n", "0123456789" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, b = (sorted(map(tuple, P.token_counts(docs, v).collect())) for v in (VOCABULARY, other))
    assert a == b
