"""Relational operators on small fixtures."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import incremental, lore, motifs, ordering, profile, reconcile, retrieval

from .conftest import rows
from .test_functions import lcs

# ---- reconcile ----


def test_priority_wins_sources_are_united_and_types_stay_apart(spark):
    df = spark.createDataFrame(
        [(1, "boss", "Radahn", "base", 2), (2, "boss", "radahn!", "dlc", 1), (3, "boss", "Radahn", "api", 3), (4, "npc", "Radahn", "api", 3), (5, "boss", "Radahn", "old", None), (6, "boss", "?!", "x", 1)],
        "ordinal int, entity_type string, name string, source string, priority int",
    )
    got = {(r["entity_type"], r["slug"]): (r["name"], r["sources"]) for r in reconcile.reconcile(df).collect()}
    assert got == {("boss", "radahn"): ("radahn!", ["dlc", "base", "api", "old"]), ("npc", "radahn"): ("Radahn", ["api"])}


def test_canonical_merge(spark):
    df = spark.createDataFrame(
        [("Zweihander", "b", "7", 2, None, 1.0), ("zweihander ", "d", "9", 1, True, 2.0), ("Axe", "b", "1", 2, False, 3.0), ("!!!", "b", "x9", None, None, 4.0), (None, "b", None, 1, None, 5.0)],
        "name string, source string, source_id string, source_priority int, is_dlc boolean, weight double",
    )
    got = [tuple(r) for r in reconcile.canonical_merge(df).orderBy("id").select("id", "canonical_slug", "name", "source", "is_dlc", "weight").collect()]
    assert got == [(1, "", "!!!", "b", False, 4.0), (2, "axe", "Axe", "b", False, 3.0), (3, "zweihander", "zweihander ", "d", True, 2.0)]
    assert reconcile.canonical_merge(df.limit(0)).count() == 0


def test_numbered_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = ordering.numbered(df.repartition(7), ["k"], "n").collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(i, i + 1) for i in range(1000)]
    assert ordering.numbered(df.limit(0), ["k"], "n").count() == 0


def test_followed_over_partitions(spark):
    data = [(g, i * 3) for g, n in ((1, 2000), (2, 1), (3, 7)) for i in range(n)]
    df = spark.createDataFrame(data, "g int, i int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.followed(df, "g", "i", "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = {1: 2000, 2: 1, 3: 7}
    assert sorted((r["g"], r["i"], r["n"] if r["n"] is not None else -1) for r in got) == sorted((g, i, i + 3 if i + 3 < 3 * sizes[g] else -1) for g, i in data)
    assert ordering.followed(df.limit(0), "g", "i", "n").count() == 0


def test_text_preference_buckets_and_conflicts(spark):
    df = spark.createDataFrame([(1, "k", "api text", "api"), (2, "k", " ", "fmg"), (3, "k", "base text", "base"), (4, "l", None, "fmg"), (5, "k", "odd", "else")], "ordinal int, key string, description string, source string")
    assert rows(reconcile.preferred_text(df, "key", "description", "source", ["fmg", "dlc", "base", "api"])) == [("k", "base text")]
    named = spark.createDataFrame([(5, "A b", None), (3, "a B!", " "), (9, "a b", "d9"), (7, "a b", "d7"), (1, "--", "x")], "id int, name string, description string")
    assert rows(reconcile.name_bucket(named, "id", "name", "description")) == [("a b", 3, [3, 5, 7, 9], "d7")]
    assert rows(reconcile.column_conflicts(df, "key", ["source", "description"])) == [("description", 1), ("source", 1)]


names = st.lists(st.text("abcdé", min_size=1, max_size=9), min_size=1, max_size=12, unique=True)


@settings(max_examples=12, deadline=None)
@given(names, names, st.sampled_from([0.6, 0.82, 0.95]))
def test_similar_names_are_exact(spark, a, b, t):
    left, right = spark.createDataFrame([(x,) for x in a], "a string"), spark.createDataFrame([(x,) for x in b], "b string")
    got = {(r["a"], r["b"]) for r in reconcile.similar_names(left, right, t).collect()}
    assert got == {(x, y) for x in a for y in b if 2 * lcs(x, y) / (len(x) + len(y)) >= t}


def test_fuzzy_attach(spark):
    snippets = spark.createDataFrame([(1, "Starscourge Radahn", "boss"), (2, "Starscourge Radahm", "boss"), (3, "Starscourge Radahm", "npc"), (4, "Nothing like it", "boss"), (5, "", "boss")], "s long, name string, kind string")
    entities = spark.createDataFrame([(10, "starscourge radahn", "boss"), (11, "Starscourge Radahn", "npc"), (12, "Starscourge Radahn", "boss")], "e long, name string, kind string")
    assert rows(reconcile.fuzzy_attach(snippets, entities, 0.82, "s", "e").select("s", "e")) == [(1, 10), (2, 10), (3, 10)]
    assert rows(reconcile.fuzzy_attach(snippets, entities, 0.82, "s", "e", block="kind").select("s", "e")) == [(1, 10), (2, 10), (3, 11)]
    assert reconcile.fuzzy_attach(snippets, entities.limit(0), 0.82, "s", "e").count() == 0


def test_glob_alias_and_ancestors(spark):
    ids = spark.createDataFrame([("npc:1001",), ("npc:1",), ("npc:x",), (None,), ("a.b",)], "raw string")
    patterns = spark.createDataFrame([("npc:*", "all"), ("npc:1*", "ones"), ("npc:1001", "exact"), ("npc:x", "npc:x"), ("a?b", "dot"), ("a.*", "a.b")], "pattern string, canonical_id string")
    got = {r["raw"]: r["canonical_id"] for r in reconcile.glob_alias(ids, patterns, "raw").collect()}
    assert got == {"npc:1001": "exact", "npc:1": "ones", "npc:x": "all", None: None, "a.b": "dot"}
    with pytest.raises(ValueError, match="patterns"):
        reconcile.glob_alias(ids, patterns, "raw", most_patterns=3)
    talk = spark.createDataFrame([(123456,), (7,), (123499,)], "n long")
    known = spark.createDataFrame([(1234,), (12,), (9,)], "ancestor long")
    assert rows(reconcile.prefix_ancestor(talk, known, "n")) == [(123456, 1234), (123499, 1234), (7, None)]
    alias = spark.createDataFrame([("npc:1", "c")], "raw_id string, canonical_id string")
    assert {r["raw"]: r["canonical_id"] for r in reconcile.alias_lookup(ids, alias, "raw").collect()}["npc:1"] == "c"


# ---- incremental ----


def test_skip_and_since(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "sig string, v int")
    manifest = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 3, 1))], "sig string, recorded_at timestamp")
    assert rows(incremental.unseen(df, manifest, ["sig"])) == [("c", 3)]
    since = F.lit("2024-02-01").cast("timestamp")
    assert rows(incremental.unseen(df, manifest, ["sig"], since)) == [("b", 2), ("c", 3)]


def test_diff(spark):
    base = spark.createDataFrame([(1, "x", None), (2, "y", 1)], "k int, a string, b int")
    now = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "z", 1)], "k int, a string, b int")
    assert [r[0] for r in rows(incremental.changed(now, base, "k", ["a", "b"]))] == [2, 3]


def bundles(spark, data):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(k, op, datetime(2024, 1, d), c) for k, op, d, c in data], "annotation_id string, operation string, updated_at timestamp, checksum string")


def test_bundles_and_upsert(spark):
    manifest = bundles(spark, [("old", "upsert", 5, "h1"), ("same", "upsert", 5, "h2"), ("stale", "upsert", 5, "h3"), ("gone", "upsert", 5, "h4")]).drop("operation")
    new = bundles(spark, [("old", "upsert", 6, "n"), ("same", "upsert", 9, "h2"), ("stale", "upsert", 5, "n"), ("gone", "delete", 7, "h4"), ("new", "upsert", 1, "n"), ("never", "delete", 1, "n")])
    done = incremental.classify_bundles(new, manifest)
    assert {r["annotation_id"]: r["outcome"] for r in done.collect()} == {"old": "updated", "same": "skipped", "stale": "conflict", "gone": "deleted", "new": "created", "never": "skipped"}
    forced = incremental.classify_bundles(new, manifest, allow_conflicts=True)
    assert {r["annotation_id"]: r["outcome"] for r in forced.collect()}["stale"] == "updated"
    table = spark.createDataFrame([("old", 1), ("old", 2), ("same", 3), ("stale", 4), ("gone", 5)], "annotation_id string, v int")
    added = spark.createDataFrame([("old", 10), ("new", 11), ("stale", 12)], "annotation_id string, v int")
    once = incremental.upsert(table, done, added)
    assert rows(once) == [("new", 11), ("old", 10), ("same", 3), ("stale", 4)]
    assert rows(incremental.upsert(once, done, added)) == rows(once)


def test_revisions(spark):
    r = spark.createDataFrame([("a", 1, True, ["x", "y"]), ("a", 2, False, ["y", "z"]), ("b", 1, False, ["x"]), ("b", 3, None, [])], "annotation_id string, version int, is_current boolean, tags array<string>")
    assert [(x[0], x[1]) for x in rows(incremental.current_revision(r))] == [("a", 1), ("b", 3)]
    assert rows(incremental.tag_changes(r)) == [("a", 1, ["x", "y"], []), ("a", 2, ["z"], ["x"]), ("b", 1, ["x"], []), ("b", 3, [], [])]
    tags = spark.createDataFrame([([" a", "b", "a ", "", None, "b"],)], "t array<string>")
    assert tags.select(incremental.distinct_in_order("t")).first()[0] == ["a", "b"]
    events = spark.createDataFrame([(1, 5, 1, False), (1, 6, 2, True), (2, 5, 3, False), (2, 5, 4, False)], "k int, at int, id int, gone boolean")
    assert rows(incremental.latest(events, ["k"], "at", "id", F.col("gone"))) == [(2, 5, 4, False)]


# ---- profile ----


def test_profile_alerts_and_violations(spark):
    df = spark.createDataFrame([("a", 100, 1.0), ("b", 200, None), (None, None, None), ("a", 150, None)], "name string, hit_points int, rare double")
    p = {r["column_name"]: r for r in profile.profile(df).collect()}
    assert (p["hit_points"]["n_rows"], p["hit_points"]["max_value"], p["hit_points"]["null_percent"], p["name"]["n_unique"]) == (4, 200.0, 25.0, 2)
    assert p["rare"]["std_value"] == 0.0
    assert p["name"]["min_value"] is None
    assert [(r["level"], r["subject"]) for r in profile.alerts(profile.profile(df)).orderBy("level").collect()] == [("column", "rare"), ("overall", "nulls")]
    assert [r["subject"] for r in profile.alerts(profile.profile(df.limit(0))).collect()] == ["empty"]
    assert rows(profile.top_values(df, ["name"], 1)) == [("name", "a", 2, 1)]
    checks = [profile.not_null("name"), profile.at_least("hit_points", 120), profile.one_of("name", ["a"])]
    assert rows(profile.violations(df, checks, ["name"])) == [("at_least", "hit_points", 1), ("not_null", "name", 1), ("one_of", "name", 1), ("unique", "name", 1)]
    assert rows(profile.failing_rows(df, checks, "hit_points"))[-1] == (200, ["one_of:name"])


def test_fills_and_casts(spark):
    df = spark.createDataFrame([(1, 1.0, "b", "x"), (2, None, "a", None), (3, 4.0, None, "x"), (None, 4.0, "a", "x"), (5, 7.0, "b", "x")], "id int, x double, m string, l string")
    got = {r["id"]: r for r in profile.filled(df, {"id": "drop", "x": "median", "m": "mode", "l": "none"}).collect()}
    assert (got[2]["x"], got[3]["m"], got[2]["l"], len(got)) == (4.0, "b", "none", 4)
    c = spark.createDataFrame([("1", "x", "2024-01-01")], "a string, b string, c string")
    out = profile.coerced(c, {"a": "int", "b": "double", "c": "timestamp", "absent": "int"}).first()
    assert (out["a"], out["b"], out["c"]) == (1, None, datetime(2024, 1, 1))


# ---- motifs ----

TWO = [motifs.Motif("scarlet_rot", "Scarlet Rot", "decay", "Decay", ("rot",)), motifs.Motif("flame", "Flame", "fire", "Fire", ("flame", "ember"), ("frenzy",))]
LINES = [(1, "npc:a", "npc", "The rot spreads; flames dim"), (2, "npc:a", "npc", "rotten"), (3, "npc:b", "npc", "Frenzy of ember"), (4, None, "item", None), (5, "npc:c", "npc", "quiet")]


def lines(spark):  # noqa: ANN001, ANN201
    return spark.createDataFrame(LINES, "lore_id long, canonical_id string, category string, text string")


def test_motif_tables(spark):
    df = lines(spark)
    cover = {r["motif_slug"]: (r["match_count"], r["coverage_pct"], r["sample_ids"]) for r in motifs.coverage(df, TWO, "lore_id").collect()}
    assert cover == {"scarlet_rot": (2, 40.0, [1, 2]), "flame": (2, 40.0, [1, 3])}
    found = motifs.hits(df, TWO, "text", ["lore_id", "canonical_id"])
    assert rows(found) == [(1, "npc:a", "flame"), (1, "npc:a", "scarlet_rot"), (2, "npc:a", "scarlet_rot"), (3, "npc:b", "flame")]
    summary = {r["canonical_id"]: (r["lore_count"], r["motif_mentions"], r["unique_motifs"]) for r in motifs.entity_summary(df, found, "canonical_id", "lore_id", "category").collect()}
    assert summary == {"npc:a": (2, 3, 2), "npc:b": (1, 1, 1), "npc:c": (1, 0, 0)}
    stats = motifs.entity_motif_stats(found, "canonical_id", "lore_id")
    assert rows(stats) == [("npc:a", "flame", 1, 1), ("npc:a", "scarlet_rot", 2, 2), ("npc:b", "flame", 1, 1)]
    tops = motifs.top_motifs(stats, TWO, "canonical_id")
    assert rows(tops.select("canonical_id", "rank", "motif_slug")) == [("npc:a", 1, "scarlet_rot"), ("npc:a", 2, "flame"), ("npc:b", 1, "flame")]
    edges = motifs.graph_edges(df, found, "canonical_id", "lore_id")
    assert edges.groupBy("kind").count().orderBy("kind").collect() == [("embodies", 3), ("evokes", 4), ("speaks", 4)]
    assert rows(motifs.entity_motifs(edges, 2).drop("rank")) == [("npc:a", "scarlet_rot", 2)]
    assert rows(motifs.shared_motifs(found, "lore_id")) == [("flame", "scarlet_rot", 1)]
    cited = motifs.quotes(df, found, TWO, "canonical_id", "lore_id", "text")
    told = {r["canonical_id"]: r["summary_text"] for r in motifs.heuristic_summary(motifs.entity_summary(df, found, "canonical_id", "lore_id", "category"), tops, cited, "canonical_id", "category", "text").collect()}
    assert told == {"npc:a": "Npc npc:a evokes Scarlet Rot and Flame across 2 lines.", "npc:b": "Npc npc:b evokes Flame across 1 line."}
    unknown = spark.createDataFrame([("other",)], "motif_slug string")
    assert motifs.with_motif(unknown, TWO).first()["motif_label"] == "unknown"


def test_clusters_of_lines(spark):
    df = lines(spark)
    members = spark.createDataFrame([(1, 0), (2, 0), (3, -1)], "lore_id long, cluster_id int")
    found = motifs.hits(df, TWO, "text", ["lore_id"])
    cover = motifs.coverage(df, TWO, "lore_id")
    got = rows(motifs.cluster_density(members, found, cover, "cluster_id", "lore_id").select("cluster_id", "motif_slug", "hits", "density_pct", "delta_pct"))
    assert got == [(-1, "flame", 1, 100.0, 60.0), (0, "flame", 1, 50.0, 10.0), (0, "scarlet_rot", 2, 100.0, 60.0)]
    assert {r["global_pct"] for r in motifs.cluster_density(members, found, None, "cluster_id", "lore_id").collect()} == {None}
    assert rows(motifs.cluster_summary(members, "cluster_id")) == [(-1, 1, True), (0, 2, False)]


def test_resolve_quotes(spark):
    known = spark.createDataFrame([("e", [("l1", "The rot spreads"), ("l2", "Quiet now")])], "entity string, quotes array<struct<id:string,text:string>>")
    claims = spark.createDataFrame([("e", "l2", None), ("e", "see l1!", None), ("e", None, " the ROT  spreads"), ("e", "?", "quiet"), ("e", "zz", "other"), ("x", "l1", None)], "entity string, cid string, ctext string")
    got = motifs.resolve_quotes(claims, known, "entity", "cid", "ctext")
    assert sorted(r["quote_id"] for r in got.collect()) == ["l1", "l1", "l2", "l2"]


# ---- lore ----


def test_weighted_texts(spark):
    df = spark.createDataFrame(
        [(1, "c", "dialogue", " a b c d "), (2, "c", "description", "one two"), (3, "c", "dialogue", "e"), (4, "c", "lore", " "), (5, None, "lore", "x"), (6, "d", None, "text")],
        "o int, cid string, kind string, text string",
    )
    got = {r["cid"]: r for r in lore.weighted_texts(df, "cid", "kind", "text", "o").collect()}
    assert got["c"]["text"] == "Description:\none two\n\nDialogue:\na b c d\n\ne"
    assert got["c"]["embedding_text"] == "Description:\none two\n\none\n\nDialogue:\na b c"
    assert (got["c"]["text_type_components"], got["c"]["text_type"]) == ("description|dialogue", "description")
    assert got["d"]["text"] == "Text:\ntext"


def test_lines_and_helpers(spark):
    e = spark.createDataFrame([("c", "d1", " ", "src")], "cid string, description string, quote string, source string")
    got = lore.explode_texts(e, "cid", ["description", "quote"], ["source"])
    want = got.select(T.lore_id("cid", F.lit("description"), F.lit("d1"))).first()[0]
    assert rows(got.select("text_type", "text", "lore_id")) == [("description", "d1", want)]
    again = got.withColumn("source", F.lit("later"))
    assert [r["source"] for r in lore.union_lines(got, again).collect()] == ["src"]
    s = spark.createDataFrame([(1, "k", "b"), (2, "k", " a "), (3, "k", "b"), (4, "k", None)], "o int, k string, v string")
    assert rows(lore.joined_unique(s, "k", "v", "o")) == [("k", "b|a")]
    f = spark.createDataFrame([(1, "p", "h"), (2, "p", None), (3, "p", "i"), (1, "q", None)], "pos int, page string, head string")
    assert rows(lore.forward_filled(f, "head", ["page"], "pos")) == [(1, "p", "h"), (1, "q", None), (2, "p", "h"), (3, "p", "i")]


# ---- retrieval ----


def ranked(spark, data):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(i + 1, f"t{i}", k, v) for i, (k, v) in enumerate(data)], "rank int, id string, text_type string, vec array<double>")


def loop_interleave(kinds: list[str], k: int) -> list[int]:
    """The rounds written as a loop."""
    buckets: dict[str, list[int]] = {}
    for i, t in enumerate(kinds):
        buckets.setdefault(t.lower(), []).append(i)
    order = [t for t in retrieval.FIRST_TYPES if t in buckets] + [t for t in buckets if t not in retrieval.FIRST_TYPES]
    out: list[int] = []
    while len(out) < k and any(buckets.values()):
        for t in order:
            if buckets[t] and len(out) < k:
                out.append(buckets[t].pop(0))
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["dialogue", "Lore", "quote", "effect", "description"]), min_size=1, max_size=14), st.integers(1, 12))
def test_interleave(spark, kinds, k):
    df = ranked(spark, [(t, None) for t in kinds])
    got = [r["rank"] - 1 for r in retrieval.interleave(df, k).orderBy("position").collect()]
    assert got == loop_interleave(kinds, k)


def test_filters(spark):
    df = spark.createDataFrame([("npc", "s"), ("boss", None), (None, "t")], "category string, source string")
    assert rows(retrieval.where(df, retrieval.parse_filters(["category=npc, boss"]))) == [("boss", None), ("npc", "s")]
    assert rows(retrieval.where(df, retrieval.parse_filters(["source!=s"]))) == [(None, "t"), ("boss", None)]
    assert retrieval.parse_filters(["other=x", "category="]) == {}
    with pytest.raises(ValueError, match="filter"):
        retrieval.parse_filters(["nothing"])
    assert retrieval.candidate_window(10) == 30
    assert retrieval.candidate_window(0, 50) == 50


def test_top_k_and_search(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(8).tolist(), f"text {i % 15}", "lore" if i % 2 else "dialogue", "npc") for i in range(40)] + [(99, None, "x", "lore", "npc"), (98, [1.0], "x", "lore", "npc")]
    df = spark.createDataFrame(data, "id long, vec array<double>, text string, text_type string, category string")
    q = rng.standard_normal(8).tolist()
    cos = sorted(((-np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q), i) for i, v, *_ in data[:40]))
    assert [r["id"] for r in retrieval.top_k(df, "vec", q, 5, "id").orderBy("rank").collect()] == [i for _, i in cos[:5]]
    l2 = sorted((np.linalg.norm(np.subtract(v, q)), i) for i, v, *_ in data[:40])
    assert [r["id"] for r in retrieval.top_k(df, "vec", q, 5, "id", metric="l2").orderBy("rank").collect()] == [i for _, i in l2[:5]]
    found = retrieval.search(df, q, 6, "id", "vec", ["category=npc"], scorer=lambda t: t.str.len().astype(float))
    assert found.count() == 6
    assert len({r["text"] for r in found.collect()}) == 6
    assert retrieval.search(df, q, 3, "id", "vec", mode="raw").count() == 3


def test_dedupe_and_rerank(spark):
    a, b = [1.0, 0.0], [1.0, 0.05]
    df = ranked(spark, [("dialogue", a), ("quote", b), ("lore", a), ("dialogue", [0.0, 1.0]), ("dialogue", None), ("quote", [0.0, 0.0])])
    assert sorted(r["rank"] for r in retrieval.semantic_dedupe(df, "vec", "id").collect()) == [1, 3, 4, 5, 6]
    with pytest.raises(ValueError, match="rows"):
        retrieval.semantic_dedupe(df, "vec", "id", most=3)
    t = spark.createDataFrame([(1, "“A” b"), (2, '"a"  B'), (3, ""), (4, None)], "rank int, text string")
    assert sorted(r["rank"] for r in retrieval.text_dedupe(t).collect()) == [1, 3, 4]
    score = lambda s: pd.Series([float(len(x or "")) for x in s])
    d = spark.createDataFrame([(1, "aa"), (2, "aaaa"), (3, "aaa"), (4, "aaaaaaa")], "rank int, text string")
    assert [r["text"] for r in retrieval.rerank(d, score, pool=3).orderBy("rank").collect()] == ["aaaa", "aaa", "aa", "aaaaaaa"]
    assert [r["rank"] for r in retrieval.rerank(d, None).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_terms_and_encoder(spark):
    df = spark.createDataFrame([(1, "Ash and ember, ash."), (2, "Ember"), (3, None)], "id int, text string")
    assert rows(retrieval.term_search(df, "ASH ember").select("id", "term_count")) == [(1, 3)]
    assert df.where("id = 1").select(retrieval.terms("text")).first()[0] == ["ash", "and", "ember"]
    v = df.select(retrieval.hash_encoder(3)("text").alias("v")).collect()
    assert v[2]["v"] == [0.0, 31 / 997, 62 / 997]


def test_forward_fill_across_partitions(spark):
    from corpusloom.operators import ordering

    data = [(("hot" if i < 900 else f"g{i % 7}") if i % 31 else None, i, float(i) if i % 97 == 3 else None) for i in range(1200)]
    got = {r["i"]: r["v"] for r in ordering.filled_forward(spark.createDataFrame(data, "g string, i long, v double").repartition(5), "v", ["g"], "i").collect()}
    last: dict = {}
    for g, i, v in data:
        last[g] = v if v is not None else last.get(g)
        assert got[i] == last[g]
    assert ordering.filled_forward(spark.createDataFrame([], "g string, i long, v double"), "v", ["g"], "i").count() == 0


def test_narrowed(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "category string, n int")
    assert retrieval.narrowed(df, "category", ["a", "x"]).count() == 1
    assert retrieval.narrowed(df, "category", []).count() == 3
    with pytest.raises(ValueError, match="category"):
        retrieval.narrowed(df, "category", ["x"])


def test_batch_encoder_checks_counts(spark):
    df = spark.createDataFrame([("a b",), (None,), ("a a b",)], "text string").coalesce(1)
    coded = [r["v"] for r in retrieval.with_vectors(df, "text", retrieval.BatchEncoder(lambda t: [[len(x), 1] for x in t], 2, batch=2), "v").collect()]
    assert coded == [[3.0, 1.0], [0.0, 1.0], [5.0, 1.0]]
    for bad in (lambda t: [[1, 2]] * (len(t) + 1), lambda t: [[1]] * len(t)):
        with pytest.raises(Exception, match="vector"):
            retrieval.with_vectors(df, "text", retrieval.BatchEncoder(bad, 2), "v").collect()
    words = [r["v"] for r in retrieval.with_vectors(df, "text", retrieval.HashedWords(8), "v").collect()]
    assert words[1] == [0.0] * 8
    assert sum(x * x for x in words[2]) == pytest.approx(1)
