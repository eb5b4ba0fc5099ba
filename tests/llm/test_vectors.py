"""Nearest neighbours and clusters against brute force."""

from __future__ import annotations

import time

import numpy as np
import pytest

pytest.importorskip("corpusloom.llm")

from corpusloom.llm import clusters, neighbours  # noqa: E402

SCHEMA = "chunk_id long, embedding array<float>, text string, id string, v int"
SIZE = 16


def frame(spark, vectors: dict):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], f"text {k}", "x", 1) for k, v in vectors.items()], SCHEMA)


def usable(vectors: dict) -> tuple[list[int], np.ndarray]:
    keep = sorted(k for k, v in vectors.items() if v is not None and len(v) == SIZE and all(x is not None and np.isfinite(x) for x in v) and any(v))
    m = np.array([np.asarray(vectors[k], np.float32).astype(float) for k in keep]).reshape(-1, SIZE)
    return keep, m / np.linalg.norm(m, axis=1, keepdims=True)


def brute_pairs(vectors: dict, k: int = 5, least: float = 0.9) -> set:
    ids, m = usable(vectors)
    s = np.round(m @ m.T, 6) if len(ids) else np.zeros((0, 0))
    out = set()
    for i in range(len(ids)):
        near = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k]
        out |= {tuple(sorted((ids[i], ids[j]))) for j in near if s[i, j] >= least}
    return out


def found_pairs(spark, vectors: dict, **kw) -> set:  # noqa: ANN001, ANN003
    got = neighbours.near_pairs(frame(spark, vectors), "chunk_id", "embedding", SIZE, **kw).collect()
    assert len({(r["a"], r["b"]) for r in got}) == len(got)
    return {(r["a"], r["b"]) for r in got}


def made(seed: int, groups: int, noise: int) -> dict:
    rng = np.random.default_rng(seed)
    out, n = {}, 0
    for _ in range(groups):
        mid = rng.standard_normal(SIZE)
        for _ in range(rng.integers(2, 9)):
            n += 1
            out[n * 7 % 10_007] = (mid + 0.22 * rng.standard_normal(SIZE)) * rng.uniform(0.5, 3)
    for _ in range(noise):
        n += 1
        out[n * 7 % 10_007] = rng.standard_normal(SIZE)
    return out


def test_recall_in_one_leaf_and_many(spark, monkeypatch):
    vectors = made(1, 150, 500)
    want = brute_pairs(vectors)
    got = found_pairs(spark, vectors)
    assert len(got & want) >= 0.98 * len(want)
    assert len(got - want) <= 0.01 * len(want)  # a missed neighbour lets the next one in
    monkeypatch.setattr(neighbours, "LEAF", 40)
    got = found_pairs(spark, vectors)
    assert len(got & want) >= 0.95 * len(want)
    monkeypatch.setattr(neighbours, "BLOCK", 16)  # every leaf in several blocks
    assert found_pairs(spark, vectors) == got


def test_copies_ties_and_unusable(spark):
    a, b = np.eye(SIZE)[0], np.eye(SIZE)[0] + 0.1 * np.eye(SIZE)[1]
    vectors = {i: a for i in range(1, 30)} | {40 + i: b for i in range(3)} | {60: 2 * a, 70: None, 71: [0.0] * SIZE, 72: [1.0] * 3, 73: [None] + [1.0] * (SIZE - 1), 74: [float("nan")] + [1.0] * (SIZE - 1), 75: -a}
    assert found_pairs(spark, vectors) == brute_pairs(vectors)


def test_copies_of_another_norm_have_smaller_ids(spark):
    # 3 * a rounds to similarity 1.0 without being an exact copy, and its ids come before those of a's copies
    a = np.random.default_rng(5).standard_normal(SIZE)
    vectors = {i: 3 * a for i in range(1, 4)} | {i: a for i in range(10, 30)}
    got = neighbours.nearest(frame(spark, vectors), "chunk_id", "embedding", SIZE).collect()
    assert sorted((r["rank"], r["other"], r["similarity"]) for r in got if r["id"] == 29) == [(i + 1, x, 1.0) for i, x in enumerate((1, 2, 3, 10, 11))]
    assert found_pairs(spark, vectors) == brute_pairs(vectors)


def test_few_rows(spark):
    assert found_pairs(spark, {}) == set()
    assert found_pairs(spark, {1: np.ones(SIZE)}) == set()
    assert found_pairs(spark, {1: np.ones(SIZE), 2: np.ones(SIZE)}) == {(1, 2)}


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)
    assert neighbours.chi_square_quantile(0.995, 48) == pytest.approx(76.969, abs=1e-3)


def test_clusters(spark):
    rng = np.random.default_rng(4)
    vectors, want = {}, []
    for size in (12, 10, 40, 9):
        mid = rng.standard_normal(SIZE) * 3
        ids = []
        for _ in range(size):
            k = int(rng.integers(1, 10**6))
            while k in vectors:
                k += 1
            vectors[k] = mid + 0.8 * rng.standard_normal(SIZE)
            ids.append(k)
        want.append(sorted(ids))
    vectors |= {2_000_000 + i: v for i, v in enumerate(np.eye(SIZE)[:6] * 4)} | {3_000_000: None, 3_000_001: [0.0] * SIZE}
    got: dict[int, list[int]] = {}
    found = clusters.clusters(frame(spark, vectors), "chunk_id", "embedding", SIZE).collect()
    for r in found:
        got.setdefault(r["cluster"], []).append(r["id"])
    assert len({r["id"] for r in found}) == len(found)
    ids, m = usable(vectors)
    place = {k: i for i, k in enumerate(ids)}
    for c, members in got.items():
        mean = m[[place[k] for k in members]].mean(0)
        reach = {k for k in ids if m[place[k]] @ mean / np.linalg.norm(mean) >= 0.65}
        assert c == min(members)
        assert set(members) == reach
    big = [set(w) for w in want if len(w) >= 10]
    assert all(any(len(w & set(g)) >= 0.9 * len(w) for g in got.values()) for w in big)


def test_cluster_queries(spark):
    same = {i: np.ones(SIZE) for i in range(12)} | {100 + i: np.eye(SIZE)[i] for i in range(9)}
    t = frame(spark, same)
    members = clusters.clusters(t, "chunk_id", "embedding", SIZE)
    assert sorted((r["a"], r["b"]) for r in clusters.chained(members).collect()) == [(i, i + 1) for i in range(11)]
    told = clusters.described(members, t, "chunk_id", "text", 2).orderBy("rank").collect()
    assert [(r["cluster"], r["size"], r["id"], r["text"]) for r in told] == [(0, 12, 0, "text 0"), (0, 12, 1, "text 1")]
    assert clusters.clusters(frame(spark, {1: np.ones(SIZE)}), "chunk_id", "embedding", SIZE).count() == 0
    assert clusters.clusters(frame(spark, {}), "chunk_id", "embedding", SIZE).count() == 0


def test_features_stay_bounded(monkeypatch):
    monkeypatch.setattr(clusters, "MOST_FEATURES", 50)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, SIZE))
    held = clusters.Features(SIZE, 0.9)
    held.add(np.ones(400), x / np.linalg.norm(x, axis=1, keepdims=True))
    assert len(held.n) <= 50
    assert held.n.sum() == pytest.approx(400)


def test_likeness_stays_the_same_at_every_size(monkeypatch):
    monkeypatch.setattr(clusters, "MOST_FEATURES", 50)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, SIZE))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    held = clusters.Alike(SIZE, 0.9)
    held.add(np.ones(400), x)
    assert len(held.n) <= 50
    assert held.alike == 0.9
    assert sorted(np.concatenate(clusters.parted(x, 60)).tolist()) == list(range(400))
    assert max(map(len, clusters.parted(x, 60))) <= 60


def sets(found) -> list[list[int]]:  # noqa: ANN001
    got: dict[int, list[int]] = {}
    for r in found.collect():
        got.setdefault(r["cluster"], []).append(r["id"])
    return sorted(sorted(x) for x in got.values())


def test_clusters_are_found_where_features_are_set_aside(spark, monkeypatch):
    monkeypatch.setattr(clusters, "MOST_FEATURES", 8)
    monkeypatch.setattr(clusters, "OUTSIDE", 20)
    mids = np.linalg.qr(np.random.default_rng(2).standard_normal((SIZE, SIZE)))[0]
    rng = np.random.default_rng(3)
    vectors = {i: mids[i % 12] + 0.1 * rng.standard_normal(SIZE) for i in range(144)}
    assert sets(clusters.clusters(frame(spark, vectors), "chunk_id", "embedding", SIZE)) == [list(range(i, 144, 12)) for i in range(12)]


def test_loose_cluster(spark):
    # ten rows of pairwise likeness 0.42: 0.69 to the mean, and no two at 0.5
    loose = np.linalg.cholesky(0.42 * np.ones((10, 10)) + 0.58 * np.eye(10))
    vectors = {i: np.concatenate([loose[i], np.zeros(SIZE - 10)]) for i in range(10)} | {100 + i: np.eye(SIZE)[10 + i] for i in range(6)}
    assert sets(clusters.clusters(frame(spark, vectors), "chunk_id", "embedding", SIZE)) == [list(range(10))]


def test_settled_applies_smallest_after_any_number_of_rounds(spark):
    vectors = {i: np.eye(SIZE)[0] for i in range(12)} | {100 + i: np.eye(SIZE)[1] for i in range(7)}
    rows = frame(spark, vectors).selectExpr("chunk_id AS id", "embedding AS v")
    assert np.allclose(clusters.settled(rows, np.eye(SIZE)[:2], 0.65, 10), np.eye(SIZE)[:1])
    a, b = np.eye(SIZE)[:2], np.eye(SIZE)[1:3]
    assert clusters.same_means(a, a[::-1])
    assert not clusters.same_means(a, b)


def test_search_finds_the_nearest_of_stated_queries(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(5)
    mids = rng.standard_normal((12, SIZE))
    vectors = {i: mids[i % 12] + 0.7 * rng.standard_normal(SIZE) for i in range(600)} | {1000: mids[0], 1001: mids[0], 1002: None}
    rows = frame(spark, vectors).where("embedding IS NOT NULL").selectExpr("chunk_id AS id", "embedding AS v")
    got: dict[int, list] = {}
    for r in neighbours.search(rows.where("id % 20 = 0 OR id = 1000"), rows, SIZE, 4).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["similarity"]))
    ids, m = usable(vectors)
    hits = 0
    for q, found in got.items():
        s = np.round(m @ m[ids.index(q)], 6)
        want = sorted((-x, k) for x, k in zip(s.tolist(), ids) if k != q)[:4]
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4]
        hits += len({k for _, k in want} & {o for _, o, _ in found})
    assert set(got) == {*range(0, 600, 20), 1000}
    assert hits >= 0.9 * 4 * len(got)
    assert sorted(got[1000])[0][1:] == (1001, 1.0)
    assert neighbours.search(rows.where("id < 0"), rows, SIZE).count() == 0
    assert neighbours.search(rows, rows.where("id < 0"), SIZE).count() == 0


def test_many_means_are_compared_in_blocks():
    rng = np.random.default_rng(4)
    u = rng.standard_normal((4000, 128))
    u[1000:1500] = u[:500] + 0.2 * rng.standard_normal((500, 128))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    began = time.perf_counter()
    assert clusters.same_means(u, u[rng.permutation(4000)])
    assert not clusters.same_means(u, np.concatenate([u[1:], u[1:2]]))
    order, keep = rng.permutation(4000), rng.random(4000) < 0.9
    got = clusters._apart(u, order, keep, 0.9)
    assert time.perf_counter() - began < 10  # row by row it's a multiple
    want = keep.copy()
    for k, i in enumerate(order):
        if want[i]:
            want[order[k + 1 :][u[order[k + 1 :]] @ u[i] >= 0.9]] = False
    assert (got == want).all() and 0 < want.sum() < keep.sum()
