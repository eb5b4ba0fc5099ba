"""Shared spans against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("corpusloom.llm")

from corpusloom.llm import spans  # noqa: E402

from ..conftest import rows  # noqa: E402


def brute(docs: list[tuple[int, str | None]], least: int) -> list[tuple[int, int, int]]:
    held: dict[str, set[int]] = {}
    for k, t in docs:
        for i in range(len(t or "") - least + 1):
            held.setdefault(t[i : i + least], set()).add(k)
    out = []
    for k, t in docs:
        shared = [False] * len(t or "")
        for i in range(len(t or "") - least + 1):
            if len(held[t[i : i + least]]) > 1:
                shared[i : i + least] = [True] * least
        i = 0
        while i < len(shared):
            j = i
            while j < len(shared) and shared[j]:
                j += 1
            if j > i:
                out.append((k, i, j - i))
            i = j + 1
    return sorted(out)


def found(spark, docs, least):  # noqa: ANN001, ANN201
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS t", "3 AS n")
    return sorted(tuple(r) for r in spans.shared_spans(df, least=least).collect())


def test_random_texts(spark):
    rng = random.Random(11)
    for least, alphabet in ((20, "ab"), (30, "abcdefgé日\U0001f480 "), (24, "xy \n")):
        word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))  # noqa: B023, E731
        passages = [word(rng.randrange(least - 3, 4 * least)) for _ in range(6)]
        docs: list[tuple[int, str | None]] = [(i, "".join(rng.choice(passages) if rng.random() < 0.5 else word(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6)))) for i in range(40)]
        docs += [(100, None), (101, ""), (102, word(least - 1)), (103, docs[0][1]), (104, docs[0][1]), (105, "a" * 500), (106, "a" * 300)]
        assert found(spark, docs, least) == brute(docs, least)


def test_repeats_within_one_text_and_a_hot_passage(spark):
    passage = "".join(chr(0x400 + (i * i * 7 + i) % 300) for i in range(250))
    assert found(spark, [(1, passage + "x" + passage)], 200) == []
    docs = [(i, f"{i} begins " + passage + f" and {i} ends") for i in range(60)] + [(99, passage + passage)]
    assert found(spark, docs, 200) == brute(docs, 200)


def test_empty_and_share(spark):
    assert found(spark, [], 200) == []
    t = "abcdefghij" * 30
    df = spark.createDataFrame([(1, t), (2, t), (3, None), (4, ""), (5, "short")], "doc_id long, text string")
    assert rows(spans.shared_share(df)) == [(1, 300, 300, 1, 1.0), (2, 300, 300, 1, 1.0), (3, None, 0, 0, None), (4, 0, 0, 0, None), (5, 5, 0, 0, 0.0)]


def test_smallest_in():
    rng = np.random.default_rng(2)
    for n, w in ((5, 5), (17, 4), (100, 7), (9, 1)):
        x = rng.integers(0, 50, n).astype(np.uint64)
        assert spans.smallest_in(x, w).tolist() == [x[i : i + w].min() for i in range(n - w + 1)]
