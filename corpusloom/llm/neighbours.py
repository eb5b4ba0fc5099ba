"""The k most similar vectors of every vector, by stable projections in a kd-tree.

Inner products with Gaussian vectors (a 2-stable law) map unit vectors to a few dimensions, where the
squared distance of two vectors at distance d is d**2 times a chi-square variable. Over the first
projections stands a kd-tree, its medians fitted on a bounded sample, whose leaves hold every row.

1. A vector looks into leaves in order of the probability that a neighbour at the largest distance of
   interest fell into them, until that mass reaches ``reach``.
2. In a leaf a neighbour is verified only if its squared projected distance is within the chi-square
   quantile of that distance: the stopping test, which is the same for each further neighbour, as no
   farther one can be a case.
3. What remains is verified on the vectors themselves, and the best k of each vector are kept.

Each leaf pairs its own rows with its visitors, in blocks of bounded size. Rows carry their projections
in bytes there, not their vectors. Equal vectors are one row for all of this; of these only the k + 1
smallest ids can be anyone's nearest ones, so a group of copies of any size costs nothing.

Defined cases: embeddings that are null, of another size, all zero or not finite have no neighbours and are
none; a vector alone has none; similarities are rounded to 6 decimals, of equal ones the smaller id comes
first; an empty table gives no rows; extra columns are ignored. Accuracy: README has the measured recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .vectors import stack, usable_vectors

#: Projections compared in a leaf, and their scale in a signed byte.
DIMENSIONS = 48
_STEP = 1 / 28

#: Rows that the tree's medians are fitted on, at most.
SAMPLE = 200_000

#: Rows of a leaf compared at once with its visitors, and rows a leaf should hold.
BLOCK = 2048
LEAF = 400


def projection(size: int, seed: int = 20) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, DIMENSIONS))


def chi_square_quantile(p: float, degrees: int) -> float:
    """Inverse of the chi-square distribution function, by the incomplete gamma series and bisection."""

    def below(x: float) -> float:
        a, y = degrees / 2, x / 2
        if y <= 0:
            return 0.0
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= y / n
            total += term
        return total * math.exp(-y + a * math.log(y) - math.lgamma(a))

    lo, hi = 0.0, float(degrees)
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return (lo + hi) / 2


def fit_tree(points: np.ndarray, depth: int) -> np.ndarray:
    """Medians of a kd-tree in heap order (node i has children 2i+1 and 2i+2); level l splits dimension l."""
    splits = np.zeros(2**depth - 1)
    groups = [np.arange(len(points))]
    for level in range(depth):
        below = []
        for i, g in enumerate(groups):
            x = points[g, level]
            m = float(np.median(x)) if len(g) else 0.0
            splits[2**level - 1 + i] = m
            below += [g[x < m], g[x >= m]]
        groups = below
    return splits


_ERF = np.vectorize(math.erf, otypes=[float])
_GRID = np.linspace(-6, 6, 4801)
_NORMAL = 0.5 * (1 + _ERF(_GRID / math.sqrt(2)))


def visits(points: np.ndarray, splits: np.ndarray, depth: int, far: float | np.ndarray, reach: float, least: float = 2e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves to look into: row, leaf, and whether it is the row's own.

    A neighbour at distance ``far`` (one for all rows, or each row's own) lies across a split at x with probability Phi(-x / far). Branches under ``least`` are
    left; of the leaves the likeliest are taken until their mass is ``reach``.
    """
    rows, nodes = np.arange(len(points)), np.zeros(len(points), np.int64)
    mass, own, far = np.ones(len(points)), np.ones(len(points), bool), np.broadcast_to(far, len(points))
    for level in range(depth):
        x = points[rows, level] - splits[nodes]
        right = np.interp(x / far[rows], _GRID, _NORMAL)
        side = x >= 0
        rows = np.concatenate([rows, rows])
        nodes = np.concatenate([2 * nodes + 1, 2 * nodes + 2])
        own = np.concatenate([own & ~side, own & side])
        mass = np.concatenate([mass * (1 - right), mass * right])
        keep = own | (mass >= least)
        rows, nodes, own, mass = rows[keep], nodes[keep], own[keep], mass[keep]
    order = np.lexsort((-mass, ~own, rows))
    rows, nodes, own, mass = rows[order], nodes[order], own[order], mass[order]
    total = np.cumsum(mass)
    first = np.searchsorted(rows, rows)
    before = total - mass - np.where(first > 0, total[first - 1], 0.0)
    keep = own | (before < reach)
    return rows[keep], nodes[keep] - (2**depth - 1), own[keep]


def _close(q: np.ndarray, b: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of b) whose squared projected distance is within the radius."""
    q, b = q.astype(np.float32) * np.float32(_STEP), b.astype(np.float32) * np.float32(_STEP)
    nb = (b * b).sum(1)
    out_q, out_b = [], []
    for i in range(0, len(q), 1024):
        part = q[i : i + 1024]
        d = (part * part).sum(1)[:, None] + nb[None, :] - 2 * (part @ b.T)
        x, y = np.nonzero(d <= radius)
        out_q.append(x + i)
        out_b.append(y)
    return np.concatenate(out_q), np.concatenate(out_b)


def _sampled(vectors: DataFrame, n: int, plan: np.ndarray) -> np.ndarray:
    """Projections of about SAMPLE rows, chosen by a hash of their id, at most twice as many."""

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame({"p": [x.tobytes() for x in (stack(f["v"]) @ plan)]})

    share = min(1.0, SAMPLE / n)
    chosen = vectors.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v")
    got = chosen.mapInPandas(project, "p binary").limit(2 * SAMPLE).toPandas()["p"]
    return np.frombuffer(b"".join(got), np.float64).reshape(-1, plan.shape[1])


def similar_pairs(vectors: DataFrame, size: int, least: float, reach: float = 0.9, sure: float = 0.995) -> DataFrame:
    """Pairs a < b of distinct vectors (id, v) with cosine similarity at least ``least``, and that similarity.

    Both ends look for each other, so a pair is missed only if both miss it. ``reach``: mass of leaves looked into;
    ``sure``: the chi-square level of the stopping test.
    """
    n = vectors.count()
    far = math.sqrt(2 - 2 * least)
    radius = far * far * chi_square_quantile(sure, DIMENSIONS)
    depth = max(0, min(DIMENSIONS - 1, math.ceil(math.log2(max(n, 1) / LEAF)), int(math.log2(SAMPLE / 8))))
    plan = projection(size)
    splits = fit_tree(_sampled(vectors, n, plan[:, :depth]), depth) if depth else np.zeros(0)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            points = stack(f["v"]) @ plan
            coded = np.clip(np.rint(points / _STEP), -127, 127).astype(np.int8)
            rows, leaf, own = visits(points, splits, depth, far, reach) if depth else (np.arange(len(f)), np.zeros(len(f), np.int64), np.ones(len(f), bool))
            coded = [c.tobytes() for c in coded]
            yield pd.DataFrame({"leaf": leaf, "own": own, "id": f["id"].to_numpy()[rows], "p": [coded[i] for i in rows]})

    placed = vectors.mapInPandas(place, "leaf int, own boolean, id long, p binary")
    # leaves hold about LEAF rows; one that holds many is compared block by block
    count = placed.where("own").groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    large = {r["leaf"]: r["blocks"] for r in count.where("blocks > 1").collect()}  # at most a row per leaf of the tree
    blocks = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in large.items() for x in kv]), F.col("leaf")), F.lit(1)) if large else F.lit(1)
    numbered = placed.withColumn("n", blocks).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    role = lambda x, y, host: F.named_struct(F.lit("x"), x, F.lit("y"), y, F.lit("host"), F.lit(host))
    every = F.sequence(F.lit(0), F.col("n") - 1)
    hosts = F.transform(every, lambda y: role(F.col("mine"), y, True))
    guests = F.transform(every, lambda x: role(x, F.col("mine"), False))
    met = numbered.select("leaf", "id", "p", F.inline(F.when(F.col("own"), F.concat(hosts, guests)).otherwise(guests)))

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        own = f["host"].to_numpy()
        p = np.frombuffer(b"".join(f["p"]), np.int8).reshape(len(f), DIMENSIONS)
        ids = f["id"].to_numpy()
        i, j = _close(p[~own], p[own], radius) if own.any() and not own.all() else (np.zeros(0, int), np.zeros(0, int))
        a, b = ids[~own][i], ids[own][j]
        keep = a != b
        return pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})

    near = met.groupBy("leaf", "x", "y").applyInPandas(compare, "a long, b long").distinct()
    return verified(near, vectors, least)


def search(queries: DataFrame, rows: DataFrame, size: int, k: int = 5, reach: float = 0.995) -> DataFrame:
    """The k most similar others of each query among all rows, however unlike: id, other, similarity, rank. Both sides: id, v.

    Every row stands with its vector in one leaf of the tree; a query meets its own leaf first. Its k-th best distance there is the
    stopping test of the second step: only leaves that hold a neighbour nearer than that with some probability are met, until
    ``reach`` of that probability is covered. A leaf's rows are compared in blocks, of which k for each query leave the task.
    Queries without near neighbours meet most leaves, so the work grows with such queries times rows: this is for
    a stated set of queries. Ties as in :func:`nearest`; of queries the ids are unique.
    """
    n = rows.count()
    depth = max(0, min(DIMENSIONS - 1, math.ceil(math.log2(max(n, 1) / BLOCK)), int(math.log2(SAMPLE / 8))))
    plan = projection(size)
    splits = fit_tree(_sampled(rows, n, plan[:, :depth]), depth) if depth else np.zeros(0)

    def put(guest: bool):  # noqa: ANN202
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if not len(f):
                    continue
                u = stack(f["v"])
                if not guest:
                    leaf = visits(u @ plan[:, : max(depth, 1)], splits, depth, 1.0, 0.0)[1] if depth else np.zeros(len(f), np.int64)
                    at, leaf = np.arange(len(f)), leaf
                else:
                    bound = f["bound"].to_numpy(float)
                    first = np.isnan(bound)
                    far = np.sqrt(np.maximum(2 - 2 * np.where(first, 1.0, bound), 1e-12))
                    at, leaf, own = visits(u @ plan[:, : max(depth, 1)], splits, depth, far, reach) if depth else (np.arange(len(f)), np.zeros(len(f), np.int64), np.ones(len(f), bool))
                    keep = np.where(first[at], own, ~own)  # the own leaf alone at first, the others after it
                    at, leaf = at[keep], leaf[keep]
                raw = [x.astype(np.float32).tobytes() if not isinstance(x, bytes) else x for x in (np.asarray(v, np.float32) for v in f["v"])]
                yield pd.DataFrame({"leaf": leaf, "id": f["id"].to_numpy()[at], "v": [raw[i] for i in at], "guest": guest})

        return run

    placed = "leaf int, id long, v binary, guest boolean"
    hosts = checkpointed(rows.select("id", "v").mapInPandas(put(False), placed))
    # a leaf of many rows is several tasks; there are at most as many leaves as the tree has
    large = hosts.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (8 * BLOCK)).cast("int").alias("parts")).where("parts > 1")
    parts = {r["leaf"]: r["parts"] for r in large.collect()}
    number = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("leaf")), F.lit(1)) if parts else F.lit(1)
    split = hosts.withColumn("part", F.pmod(F.xxhash64("id"), number).cast("int"))

    def best_of(s: np.ndarray, ids: np.ndarray, query: int) -> list[tuple[int, int, float]]:
        s = np.where(ids == query, -2.0, s)
        if len(s) > k:
            near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
        else:
            near = np.arange(len(s))
        near = near[s[near] > -2]
        order = near[np.lexsort((ids[near], -s[near]))][:k]
        return [(query, int(ids[j]), float(s[j])) for j in order]

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        guest = f["guest"].to_numpy()
        out: list[tuple[int, int, float]] = []
        if guest.any() and not guest.all():
            h, q = stack(f["v"][~guest]), stack(f["v"][guest])
            ids, asked = f["id"].to_numpy()[~guest], f["id"].to_numpy()[guest]
            for i in range(0, len(q), 256):
                s = np.round(q[i : i + 256] @ h.T, 6)
                for j in range(len(s)):
                    out += best_of(s[j], ids, int(asked[i + j]))
        return pd.DataFrame(out, columns=["id", "other", "similarity"])

    def met(asked: DataFrame) -> DataFrame:
        guests = asked.mapInPandas(put(True), placed).withColumn("part", F.explode(F.sequence(F.lit(0), number - 1)))
        return split.unionByName(guests).groupBy("leaf", "part").applyInPandas(compare, "id long, other long, similarity double")

    w = Window.partitionBy("id").orderBy(F.desc("similarity"), "other")
    top = lambda found: found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    asked = queries.select("id", "v")
    first = checkpointed(top(met(asked.withColumn("bound", F.lit(None).cast("double")))).drop("rank"))
    reached = first.groupBy("id").agg(F.when(F.count(F.lit(1)) == k, F.min("similarity")).otherwise(-1.0).alias("bound"))
    further = asked.join(reached.hint("merge"), "id", "left").select("id", "v", F.coalesce("bound", F.lit(-1.0)).alias("bound"))
    return top(first.unionByName(met(further)).distinct())


def verified(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """Pairs a, b with their cosine similarity, rounded to 6 decimals, of those that reach ``least``."""

    def cosine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                s = np.round((stack(f["va"]) * stack(f["vb"])).sum(1), 6)
                yield pd.DataFrame({"a": f["a"], "b": f["b"], "similarity": s})[s >= least]

    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(vectors.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")
    return both.mapInPandas(cosine, "a long, b long, similarity double")


def nearest(table: DataFrame, key: str, vector: str, size: int, k: int = 5, least: float = 0.9, reach: float = 0.9) -> DataFrame:
    """Up to k most similar others, of similarity at least ``least``, of each usable row: id, other, similarity, rank."""
    rows = usable_vectors(table, key, vector, size).withColumn("same", F.xxhash64("v")).withColumn("again", F.hash("v"))
    order = Window.partitionBy("same", "again").orderBy("id")
    heads = rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1)
    groups = checkpointed(
        heads.groupBy("same", "again").agg(F.min(F.struct("id", "v")).alias("one"), F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("one.id").alias("id"), F.col("one.v").alias("v"), "ids", "same", "again")
    )
    pairs = similar_pairs(groups.select("id", "v"), size, least, reach)
    ways = pairs.select(F.col("a").alias("g"), F.col("b").alias("h"), "similarity").unionByName(pairs.select(F.col("b").alias("g"), F.col("a").alias("h"), "similarity"))
    best = Window.partitionBy("g").orderBy(F.desc("similarity"), "h")
    top = ways.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)
    ids = groups.select(F.col("id").alias("h"), F.slice("ids", 1, k).alias("other_ids"))
    listed = top.join(ids, "h").groupBy("g").agg(F.flatten(F.collect_list(F.transform("other_ids", lambda x: F.named_struct(F.lit("s"), -F.col("similarity"), F.lit("other"), x)))).alias("others"))
    full = groups.select(F.col("id").alias("g"), "ids", "same", "again").join(listed, "g", "left")
    none = F.array().cast("array<struct<s:double,other:bigint>>")
    copies = F.transform("ids", lambda x: F.named_struct(F.lit("s"), F.lit(-1.0), F.lit("other"), x))
    all_others = F.concat(F.when(F.size("ids") > 1, copies).otherwise(none), F.coalesce("others", none))
    # copies beyond the first k + 1 too choose from their group's whole list, as other groups may round to 1.0 and have smaller ids
    each = rows.select("id", "same", "again").join(full.select("same", "again", all_others.alias("all")), ["same", "again"])
    chosen = each.select("id", F.slice(F.array_sort(F.filter("all", lambda x: x["other"] != F.col("id"))), 1, k).alias("best"))
    return chosen.select("id", F.posexplode("best").alias("rank", "x")).select("id", F.col("x.other").alias("other"), (-F.col("x.s")).alias("similarity"), (F.col("rank") + 1).alias("rank"))


def near_pairs(table: DataFrame, key: str, vector: str, size: int, k: int = 5, least: float = 0.9) -> DataFrame:
    """Pairs a < b with similarity at least ``least`` of which one is among the k nearest of the other."""
    found = nearest(table, key, vector, size, k, least)
    return found.groupBy(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).agg(F.max("similarity").alias("similarity"))
