"""Command line, registry, guard, processing, analysis."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.operators import analysis, guard, process, registry

from .conftest import rows


@pytest.fixture()
def call(spark, monkeypatch):  # noqa: ANN001, ANN201
    monkeypatch.setattr(cli, "session", lambda *_: spark)
    return lambda *a: cli.main([str(x) for x in a])


def test_curate(spark, call, tmp_path, capsys):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    (raw / "weapons.csv").write_text("id,name,description\n1,Uchigatana,A blade\n2, ,none\n")
    (raw / "dlc_weapons.csv").write_text("id,name,description\n9,UCHIGATANA,Better\n")
    assert call("curate", "--input", raw, "--output", out) == 0
    meta = json.loads((out / "metadata.json").read_text())
    assert meta["total"] == 2
    assert call("curate", "--input", raw, "--output", out, "--incremental") == 0
    assert "nothing changed" in capsys.readouterr().out


def test_process_and_registry(spark, call, tmp_path, capsys):
    path = tmp_path / "w.csv"
    path.write_text('ID,Name,Weapon Type,Weight\n1,Blade,Straight Swords,3.5\n1,,Bow,-2\nx,Axe,Katana,"n/a"\n')
    assert call("process", "--input", path, "--dataset", "weapons", "--output", tmp_path / "o") == 1
    said = capsys.readouterr().out.splitlines()
    assert sorted(said) == ["at_least weight: 1", "not_null name: 1", "not_null weapon_id: 1", "unique weapon_id: 1"]
    assert rows(spark.read.parquet(str(tmp_path / "o")).select("weapon_id", "weapon_type", "weight")) == [(None, "other", None), (1, "bow", -2.0), (1, "sword", 3.5)]
    assert registry.find("Weapons").tag == "weapons_v1"
    assert registry.find("armor_v1").dataset == "armor"
    assert registry.find("armor_v9") is None
    assert registry.find("arm") is None
    with pytest.raises(ValueError, match="schema"):
        process.process(spark.range(1), "horses")
    _, broken = registry.validate(spark.createDataFrame([("a",)], "name string"), registry.find("bosses"))
    assert ("missing_column", "boss_id", 1) in rows(broken)
    named = process.normalized_names(spark.createDataFrame([(1, 2, 3)], "`Weapon Type` int, `weapon-type` int, dmgNegation int"))
    assert named.columns == ["weapon_type", "weapon_type_2", "dmg_negation"]
    assert rows(process.statistics(named))[0] == ("dmg_negation", "int", 1, 0)


def test_ingest(spark, call, tmp_path, capsys):
    store = tmp_path / "store"

    def bundle(name: str, day: int, text: str, operation: str = "upsert") -> None:
        d = tmp_path / "bundles" / name
        d.mkdir(parents=True, exist_ok=True)
        (d / "bundle.yml").write_text(f"bundle: {{id: {name}, operation: {operation}, updated_at: '2024-01-0{day}T00:00:00Z'}}\nannotation: {{id: {name}, text: {text}}}\n")

    def outcome() -> dict:
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    bundle("a", 2, "one")
    bundle("b", 2, "one")
    assert call("ingest", "--bundles", tmp_path / "bundles", "--store", store) == 0
    assert outcome() == {"created": 2}
    bundle("a", 3, "two")
    bundle("b", 1, "stale")
    assert call("ingest", "--bundles", tmp_path / "bundles", "--store", store) == 1
    assert outcome() == {"updated": 1, "conflict": 1}
    bundle("b", 4, "x", "delete")
    assert call("ingest", "--bundles", tmp_path / "bundles", "--store", store) == 0
    assert outcome() == {"skipped": 1, "deleted": 1}
    assert [json.loads(r["annotation"])["text"] for r in spark.read.parquet(str(store / "annotations")).collect()] == ["two"]


def test_index_query_guard_analyse_stats(spark, call, tmp_path, capsys):
    lines = [(i, f"npc:{i % 7}", "npc" if i % 2 else "boss", ["lore", "dialogue"][i % 2], "s", f"The rot and flame number {i} spreads over land {i * i}") for i in range(60)]
    lore = tmp_path / "lore"
    spark.createDataFrame(lines, "lore_id long, canonical_id string, category string, text_type string, source string, text string").coalesce(1).write.parquet(str(lore))
    assert call("index", "--lore", lore, "--output", tmp_path / "ix") == 0
    assert call("query", "rot", "--index", tmp_path / "ix", "--top-k", 3, "--mode", "raw") == 0
    said = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [x["position"] for x in said] == [1, 2, 3]
    assert call("guard", "--lore", lore, "--index", tmp_path / "ix") == 0
    assert call("guard", "--lore", lore / "_SUCCESS", "--index", tmp_path / "ix") == 1
    (tmp_path / "t.yml").write_text("categories:\n- slug: d\n  label: D\n  motifs:\n  - {slug: rot, label: Rot}\n  - {slug: fire, label: Flame}\n")
    for what, table in (("coverage", "coverage"), ("graph", "graph/edges"), ("summaries", "summaries"), ("clusters", "density")):
        assert call("analyse", what, "--lore", lore, "--taxonomy", tmp_path / "t.yml", "--output", tmp_path / "an", "--clusters", 3) == 0
        assert spark.read.parquet(str(tmp_path / "an" / table)).count() > 0
    assert call("stats", "--lore", lore) == 0
    assert "| text_type | lore | 30 | 7 |" in capsys.readouterr().out


def test_fingerprints(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    one = guard.guard_state({"f": str(tmp_path)}, {"k": 1})
    assert guard.unchanged(one, guard.guard_state({"f": str(tmp_path)}, {"k": 1}))
    (tmp_path / "a.txt").write_text("y")
    assert not guard.unchanged(guard.guard_state({"f": str(tmp_path)}, {"k": 1}), one)
    assert not guard.unchanged(one, None)
    hashes = guard.folder_hashes(spark, str(tmp_path), "*.txt")
    cache = hashes.withColumn("schema_tag", F.lit("v1"))
    assert guard.pending(hashes, cache, "v1").count() == 0
    assert guard.pending(hashes, cache, "v2").count() == 1
    assert guard.pending(hashes, cache, "v1", force=True).count() == 1


def test_components_clusters_sample(spark):
    rng = np.random.default_rng(0)
    data = [(i, (np.eye(8)[i % 2] * 5 + 0.1 * rng.standard_normal(8)).tolist()) for i in range(60)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    out = analysis.clustered(analysis.components(df, "v", 2), "components", 2, smallest=5, farthest=1.0)
    got = {r["id"]: r["cluster_id"] for r in out.collect()}
    assert len({got[i] for i in range(0, 60, 2)}) == len({got[i] for i in range(1, 60, 2)}) == 1
    assert got[0] != got[1]
    assert rows(analysis.sampled(df, "id", 5).select("id")) == rows(analysis.sampled(df.repartition(7), "id", 5).select("id"))
