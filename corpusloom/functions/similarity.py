"""Similarity of texts and vectors as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence of two texts, by dynamic programming in array functions."""
    x, y = F.split(_c(a), ""), F.split(_c(b), "")
    width = F.length(_c(b))
    start = F.array_repeat(F.lit(0), width + 1)

    def row(prev: Column, ch: Column) -> Column:
        cell = lambda acc, j: F.concat(
            acc,
            F.array(F.when(F.get(y, j - 1) == ch, F.get(prev, j - 1) + 1).otherwise(F.greatest(F.get(prev, j), F.get(acc, j - 1)))),
        )
        return F.when(width > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), F.array(F.lit(0)), cell)).otherwise(prev)

    return F.when(F.length(_c(a)) == 0, 0).otherwise(F.element_at(F.aggregate(x, start, row), -1))


def ratio(a: Column | str, b: Column | str) -> Column:
    """Indel similarity of two texts, 0 to 1: twice their common subsequence over their lengths; two empty texts are equal."""
    total = F.length(_c(a)) + F.length(_c(b))
    return F.when(total == 0, 1.0).otherwise(2.0 * lcs_length(a, b) / total)


def ratio_possible(a: Column | str, b: Column | str, least: float) -> Column:
    """Whether the lengths of two texts allow a ratio of ``least``."""
    short, long = F.least(F.length(_c(a)), F.length(_c(b))), F.greatest(F.length(_c(a)), F.length(_c(b)))
    return short >= long * (least / (2 - least))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in doubles."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column | str) -> Column:
    """Vector of length 1; a zero vector stays."""
    n = norm(a)
    return F.transform(_c(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def l2_distance(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of cells at a time: each row is one addition on bit vectors."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def batch_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """:func:`ratio` for many pairs: Arrow batches and bit vectors, where array functions would interpret every cell."""
    return pd.Series([1.0 if not x and not y else 2.0 * common_letters(x, y) / (len(x) + len(y)) for x, y in zip(a, b)])
