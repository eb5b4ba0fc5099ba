"""Retrieval: filtered exact vector top-k, text and semantic dedupe, reranking, balanced interleave, term search."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

LOG = logging.getLogger(__name__)

# Columns that may be filtered, text types compared by meaning, types shown first, and the widening of the candidate window.
FILTER_COLUMNS = ("category", "text_type", "source")
SEMANTIC_TYPES = ("dialogue", "quote")
FIRST_TYPES = ("description", "lore", "impalers_excerpt", "dialogue")
WINDOW_FACTOR = 3
SAME_MEANING = 0.97


@dataclass
class Clause:
    """Values a column must have, and must not have."""

    include: set[str] = field(default_factory=set)
    exclude: set[str] = field(default_factory=set)


def parse_filters(expressions: list[str], allowed: tuple[str, ...] = FILTER_COLUMNS) -> dict[str, Clause]:
    """Clauses of ``column=a,b`` and ``column!=a,b``; other columns and empty values are ignored with a warning."""
    clauses: dict[str, Clause] = {}
    for e in expressions:
        negative = "!=" in e
        column, sep, values = e.partition("!=" if negative else "=")
        if not sep:
            raise ValueError(f"not a filter: {e!r}")
        column, listed = column.strip(), {v.strip() for v in values.split(",") if v.strip()}
        if column not in allowed or not listed:
            LOG.warning("filter ignored: %s", e)
            continue
        clause = clauses.setdefault(column, Clause())
        (clause.exclude if negative else clause.include).update(listed)
    return clauses


def where(df: DataFrame, clauses: dict[str, Clause]) -> DataFrame:
    """Rows that satisfy all clauses; a null value is in no include set and no exclude set. Unknown columns are ignored."""
    for column, clause in clauses.items():
        if column not in df.columns:
            continue
        if clause.include:
            df = df.where(F.col(column).isin(*sorted(clause.include)))
        if clause.exclude:
            df = df.where(~F.coalesce(F.col(column).isin(*sorted(clause.exclude)), F.lit(False)))
    return df


def narrowed(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose column has one of the values (all rows without values); an error if there is none, as what follows would be empty for a misspelling."""
    out = df.where(F.col(column).isin(*values)) if values else df
    if values and out.isEmpty():
        raise ValueError(f"no rows with {column} in {sorted(values)}")
    return out


def score_udf(query: list[float], metric: str = "cosine"):  # noqa: ANN201
    """Similarity (cosine, inner) or distance (l2) of a column of vectors to one query, a batch at a time; null for other sizes."""
    q = np.asarray(query, np.float64)
    qn = np.linalg.norm(q)

    @F.pandas_udf("double")
    def score(v: pd.Series) -> pd.Series:
        ok = np.fromiter((x is not None and len(x) == len(q) for x in v), bool, len(v))
        out = np.full(len(v), np.nan)
        if ok.any():
            m = np.stack([np.asarray(x, np.float64) for x in v[ok]])
            if metric == "l2":
                out[ok] = np.sqrt(((m - q) ** 2).sum(1))
            else:
                dots = m @ q
                with np.errstate(invalid="ignore", divide="ignore"):
                    out[ok] = dots if metric == "inner" else dots / (np.linalg.norm(m, axis=1) * qn)
        return pd.Series(out).where(~np.isnan(out), None)

    return score


def top_k(df: DataFrame, vector: str, query: list[float], k: int, key: str, clauses: dict[str, Clause] | None = None, metric: str = "cosine") -> DataFrame:
    """Exact top k of the rows that satisfy the clauses: key, score (6 decimals), rank; ties by key.

    Filters stand before the scores, so they reach the scan; each task sends its best k rows only.
    """
    scored = where(df, clauses or {}).select("*", F.round(score_udf(query, metric)(F.col(vector)), 6).alias("score")).where(F.col("score").isNotNull())
    first = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    best = scored.orderBy(first, key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(first, key)))  # k rows


def candidate_window(k: int, pool: int | None = None) -> int:
    """How many rows are fetched for a result of k."""
    return max(max(1, k) * WINDOW_FACTOR, pool or 0)


def text_dedupe(ranked: DataFrame, text: str = "text", rank: str = "rank") -> DataFrame:
    """The best ranked row of each text, compared without quotes', dashes', spaces' and case's kinds; blank texts all stay."""
    norm = T.query_text(text)
    same = F.when(norm != "", norm).otherwise(F.concat(F.lit("\x00"), F.col(rank).cast("string")))
    rest = F.struct(*[F.col(c) for c in ranked.columns])
    return ranked.groupBy(same.alias("_t")).agg(F.min_by(rest, rank).alias("r")).select("r.*")


def semantic_dedupe(ranked: DataFrame, vector: str, key: str, text_type: str | None = "text_type", rank: str = "rank", same: float = SAME_MEANING, most: int = 5000) -> DataFrame:
    """Rows left when each one of the semantic types is dropped that is as like as ``same`` to a kept one ranked before it.

    The order decides, so one task goes through the rows; their number (a candidate window) is checked.
    """
    if ranked.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: dedupe a candidate window, not a table")

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = pd.concat(list(frames)).sort_values(["r", "k"])
        kept: list[np.ndarray] = []
        out = []
        for r in f.itertuples():
            if r.s and r.v is not None and np.any(r.v):
                v = np.asarray(r.v, np.float64)
                v = v / np.linalg.norm(v)
                if kept and max(float(v @ x) for x in kept) >= same:
                    continue
                kept.append(v)
            out.append(r.k)
        yield pd.DataFrame({"k": out})

    meant = F.lit(True) if text_type is None else F.coalesce(F.lower(text_type).isin(*SEMANTIC_TYPES), F.lit(False))
    small = ranked.select(F.col(rank).alias("r"), F.col(key).alias("k"), F.col(vector).alias("v"), meant.alias("s")).coalesce(1)
    ids = small.mapInPandas(keep, f"k {dict(ranked.dtypes)[key]}").withColumnRenamed("k", key)
    return ranked.join(ids, key, "left_semi")


def rerank(ranked: DataFrame, scorer: Callable[[pd.Series], pd.Series] | None, text: str = "text", pool: int = 50, rank: str = "rank") -> DataFrame:
    """Rows reordered: the first ``pool`` by the scorer's score (ties by rank), then the rest as they were. Without scorer as they were."""
    if scorer is None:
        return ranked.withColumn("rerank_score", F.lit(None).cast("double"))
    score = F.pandas_udf(scorer, "double")
    inside = F.col(rank) <= pool
    scored = ranked.withColumn("rerank_score", F.when(inside, score(F.col(text))))
    order = Window.orderBy(F.desc(inside.cast("int")), F.desc_nulls_last("rerank_score"), rank)
    return scored.withColumn(rank, F.row_number().over(order))  # a candidate window


def interleave(ranked: DataFrame, k: int, text_type: str = "text_type", rank: str = "rank") -> DataFrame:
    """Balanced order: types take turns, their best first; types of FIRST_TYPES in that order, then by first appearance. First k rows, with ``position``."""
    kind = F.lower(F.coalesce(F.col(text_type), F.lit("")))
    listed = F.array_position(F.array(*[F.lit(t) for t in FIRST_TYPES]), F.col("_kind"))
    by_kind = Window.partitionBy("_kind")
    turned = (
        ranked.withColumn("_kind", kind)
        .withColumn("_turn", F.row_number().over(by_kind.orderBy(rank)))
        .withColumn("_seen", F.min(rank).over(by_kind))
        .withColumn("_first", F.when(listed > 0, listed).otherwise(len(FIRST_TYPES) + 1))
    )
    order = [F.col("_turn"), F.col("_first"), F.col("_seen")]
    return turned.orderBy(*order).limit(k).withColumn("position", F.row_number().over(Window.orderBy(*order))).drop("_kind", "_turn", "_seen", "_first")


def terms(text: Column | str) -> Column:
    """Distinct words of a text, lower case."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def term_search(df: DataFrame, query: str, text: str = "text") -> DataFrame:
    """Rows that hold all words of a query, with how often they occur: term_count."""
    import re

    words = [w for w in re.split(r"[\W_]+", query.lower()) if w]
    tokens = F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")
    has = [F.array_contains(tokens, w) for w in words]
    every = has[0]
    for h in has[1:]:
        every = every & h
    return df.where(every).withColumn("term_count", F.size(F.filter(tokens, lambda w: w.isin(*words))))


def hash_encoder(dimensions: int = 16):  # noqa: ANN201
    """Stand-in encoder without a model: value i is ((sum of code points + 31 i) mod 997) / 997."""

    @F.pandas_udf("array<double>")
    def encode(text: pd.Series) -> pd.Series:
        total = text.fillna("").map(lambda t: sum(map(ord, t)))
        return total.map(lambda s: [((s + 31 * i) % 997) / 997 for i in range(dimensions)])

    return encode


class HashedWords:
    """Encoder without a model: words counted in ``dimensions`` places chosen by hash, scaled to unit length; no words give zeros."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions

    def column(self, text: Column) -> Column:
        words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        places = F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % self.dimensions).cast("int"))
        # a lambda's argument is worked out once, an expression each time it is used
        sums = lambda p: F.transform(F.sequence(F.lit(0), F.lit(self.dimensions - 1)), lambda i: (F.size(p) - F.size(F.array_remove(p, i))).cast("double"))
        length = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y * y))
        scaled = lambda c: F.transform(c["x"], lambda v: F.when(v > 0, v / c["n"]).otherwise(0.0))
        counted = F.transform(F.array(places), sums)
        return F.element_at(F.transform(F.transform(counted, lambda x: F.struct(x.alias("x"), length(x).alias("n"))), scaled), 1)


class BatchEncoder:
    """Encoder around a function of a batch of texts that gives one vector of ``dimensions`` numbers for each (a model, a service)."""

    def __init__(self, encode: Callable[[list[str]], list], dimensions: int, batch: int = 64) -> None:
        self.encode, self.dimensions, self.batch = encode, dimensions, batch

    def column(self, text: Column) -> Column:
        encode, dimensions, batch = self.encode, self.dimensions, self.batch

        @F.pandas_udf("array<double>")
        def run(texts: pd.Series) -> pd.Series:
            given, out = texts.fillna("").tolist(), []
            for i in range(0, len(given), batch):
                part = given[i : i + batch]
                vectors = [[float(x) for x in v] for v in encode(part)]
                if len(vectors) != len(part):
                    raise ValueError(f"{len(part)} texts, but {len(vectors)} vectors")
                if any(len(v) != dimensions for v in vectors):
                    raise ValueError(f"a vector doesn't have {dimensions} values")
                out += vectors
            return pd.Series(out, dtype=object)

        return run(text)


def with_vectors(df: DataFrame, text: str, encoder: HashedWords | BatchEncoder, name: str = "embedding") -> DataFrame:
    """Rows with the vector of their text; distinct texts of rows aren't sought out, each row is encoded where it lies."""
    return df.withColumn(name, encoder.column(F.col(text)))


def search(df: DataFrame, query: list[float], k: int, key: str, vector: str, filters: list[str] | None = None, mode: str = "balanced", scorer: Callable[[pd.Series], pd.Series] | None = None, pool: int | None = None) -> DataFrame:
    """The whole path: filters, exact top of the candidate window, dedupe by text and meaning, rerank, order by mode (balanced or raw), first k."""
    window = top_k(df, vector, query, candidate_window(k, pool), key, parse_filters(filters or []))
    distinct = semantic_dedupe(text_dedupe(window), vector, key)
    best = rerank(distinct, scorer, pool=pool or 50)
    if mode == "raw":
        return best.orderBy("rank").limit(k).withColumn("position", F.row_number().over(Window.orderBy("rank")))
    return interleave(best, k)


