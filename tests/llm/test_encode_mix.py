"""Encoding and mixing."""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("corpusloom.llm")

from corpusloom.llm import encode, mixing  # noqa: E402

from ..conftest import rows  # noqa: E402

VOCABULARY = encode._vocabulary(encode.FOLDER, "byte_bpe_50k")


@pytest.fixture(scope="module")
def plain():  # noqa: ANN201
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=encode.PATTERN, mergeable_ranks=encode.read_ranks(VOCABULARY), special_tokens={})


pieces = st.sampled_from([" ", "  ", "\n", "\t", " ", "　", "the", "don't", "'s", "!'s", "<|endoftext|>", "日本語", "é ", "x́", "12 34", "​", "\U0001f480", "a.b", "...", "\r\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(pieces | st.text(max_size=8), max_size=12).map("".join), max_size=5))
def test_fragments_encode_as_the_whole(plain, texts):
    ids, offsets = encode.Encoder(VOCABULARY).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [plain.encode_ordinary(t) for t in texts]


def test_joined_pairs():
    table = encode.joined_pairs([b"ab", b"c", b"bcd"])
    assert sorted(zip(*np.nonzero(table))) == [(97, 98), (98, 99), (99, 100)]


def test_encode_table(spark, plain):
    texts = [(1, None), (2, ""), (3, "  \n "), (4, "Hello world"), (4, "Hello world"), (5, "word " * 50_000), (6, "長" * 20_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS t")
    got = {(r["doc_id"], tuple(r["ids"])) for r in encode.encode(df).collect()}
    assert got == {(k, tuple(plain.encode_ordinary(t or ""))) for k, t in texts}
    assert encode.encode(df.limit(0)).count() == 0
    counted = encode.count_tokens(df, "text").select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, counted)) == sorted((k, len(plain.encode_ordinary(t or ""))) for k, t in texts)


def test_forgets_fragments(plain, monkeypatch):
    monkeypatch.setattr(encode, "REMEMBERED", 3)
    encoder = encode.Encoder(VOCABULARY)
    for text in ("one two three four five", "six one", "two"):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == plain.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 300))
def test_fit_is_the_best_subset(counts, budget):
    taken = mixing.fit(counts, budget)
    assert all(0 <= taken[k] <= counts[k] for k in counts)
    total = sum(k * n for k, n in taken.items())
    best = max(s for s in (sum(k * n for k, n in zip(counts, use)) for use in product(*[range(n + 1) for n in counts.values()])) if s <= budget)
    have = sum(k * n for k, n in counts.items())
    assert total <= budget
    # the proportional part is taken first; what is left over is fitted exactly
    base = {k: int(n * budget / have) for k, n in counts.items()} if budget < have else counts
    rest = max(s for s in (sum(k * n for k, n in zip(counts, use)) for use in product(*[range(counts[k] - base[k] + 1) for k in counts])) if s <= budget - sum(k * n for k, n in base.items()))
    assert total == sum(k * n for k, n in base.items()) + rest <= best


def test_fit_of_large_budgets():
    rng = random.Random(1)
    counts = {rng.randrange(1, 5000): rng.randrange(1, 400) for _ in range(800)}
    have = sum(k * n for k, n in counts.items())
    for share in (0.1, 0.5, 0.97):
        taken = mixing.fit(counts, int(have * share))
        assert sum(k * n for k, n in taken.items()) == int(have * share)


def test_budgets():
    t = [mixing.Target("a", 0.5, 1, 1000), mixing.Target("b", 0.3, 4, 100), mixing.Target("none", 0.2, 4, 0)]
    assert mixing.budgets(t) == {"a": 666, "b": 400, "none": 0}
    assert mixing.budgets(t, 80) == {"a": 50, "b": 30, "none": 0}
    assert mixing.budgets(t, 10_000) == {"a": 1000, "b": 400, "none": 0}
    assert mixing.budgets([mixing.Target("a", 0.0, 1, 5)]) == {"a": 0}


def test_mix(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice(["big"] * 6 + ["small", "else", None]), " ".join(["word"] * rng.randrange(1, 40))) for i in range(600)]
    docs += [(1000, "big", None), (1001, "small", ""), (1002, "gone", "x")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").selectExpr("*", "0 AS times", "0 AS n_tokens", "1 AS band")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 3), ("nowhere", 0.1, 2), (None, 0.5, 1)], "source string, target_weight double, max_repeat int")
    used = mixing.select(df, targets)
    got = {r["doc_id"]: r for r in used.collect()}
    assert {r["source"] for r in got.values()} == {"big", "small"}
    assert all(r["times"] == 3 for r in got.values() if r["source"] == "small")
    assert all(r["times"] == 1 for r in got.values() if r["source"] == "big")
    assert rows(mixing.select(df, targets).select("doc_id", "times")) == rows(used.select("doc_id", "times"))
    share = {r["source"]: r for r in mixing.shares(used, targets).collect()}
    assert share["nowhere"]["actual_share"] == 0.0
    assert abs(share["big"]["actual_share"] - 0.6 / 0.9) < 0.001
    assert mixing.repeated(used, df).count() == sum(r["times"] for r in got.values())
    assert mixing.select(df.limit(0), targets).count() == 0


def test_one_length_in_many_documents(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'big' AS source", "'a b c' AS text").unionByName(spark.range(5000, 5100).selectExpr("id AS doc_id", "'small' AS source", "'a b c d' AS text"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2)], "source string, target_weight double, max_repeat int")
    share = {r["source"]: r["n_tokens"] for r in mixing.shares(mixing.select(docs, targets), targets).collect()}
    assert share == {"big": 798, "small": 800}
