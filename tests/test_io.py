"""Readers, domain loaders, writers and streams."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import lore, profile
from corpusloom.sources import readers, records, writers
from corpusloom.streaming import incremental as streams

from .conftest import rows


def test_csv_and_sniffing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;name;note\n1;x;"line\nbreak"\n2;"say ""hi""";\n')
    assert readers.sniff_delimiter(spark, str(tmp_path / "a.csv")) == ";"
    df = readers.read_any(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("id", "string"), ("name", "string"), ("note", "string")]
    assert rows(df) == [("1", "x", "line\nbreak"), ("2", 'say "hi"', None)]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "weapons.csv").write_text("id,name\n1,x\n")
    assert rows(readers.read_csv_tree(spark, str(tmp_path / "sub"))) == [("1", "x", "weapons")]
    (tmp_path / "x.json").write_text('[{"a": 1}]')
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert readers.read_any(spark, str(tmp_path / "x.json")).count() == 1
    assert readers.read_any(spark, str(tmp_path / "x.jsonl")).count() == 2
    assert [p.rsplit("/", 1)[1] for p in readers.data_files(str(tmp_path))] == ["a.csv", "x.json"]
    with pytest.raises(ValueError, match="kind"):
        readers.read_any(spark, "x.bin")
    assert readers.existing([str(tmp_path / "no"), str(tmp_path / "a.csv")]).endswith("a.csv")
    assert readers.best_language_path(["b/fr/x.xml", "b/engus/x.xml", "a/x.xml"]) == "b/engus/x.xml"


def test_fmg_xml_captions_and_speakers(spark, tmp_path):
    (tmp_path / "n.xml").write_text('<fmg><entries><text id="12">Melina</text><text id="7">%null%</text><text id="x">bad</text><text id="9"> </text><text id="12">Melina  the\n\n\n Kindled </text></entries></fmg>')
    names = readers.read_fmg_xml(spark, str(tmp_path / "n.xml"))
    assert rows(names) == [(12, "Melina  the\n\nKindled")]
    captions = spark.createDataFrame([(12, "caption")], "id long, text string")
    got = readers.fmg_names(names, captions, "fmg").first()
    assert (got["source_id"], got["description"], got["source_priority"]) == (12, "caption", 4)
    talk = spark.createDataFrame([(1234, "hi"), (900, "ho")], "id long, text string")
    assert rows(readers.dialogue(talk, names).select("talk_id", "speaker_id", "canonical_id")) == [(1234, 12, "npc:12"), (900, None, "npc:900")]


def test_envelope_and_weapons(spark):
    body = {"success": True, "source": "api", "data": [{"id": "w1", "name": "Uchigatana", "category": "Straight Swords", "weight": 5.5, "attack": [{"name": "Phy", "amount": 113}], "requiredAttributes": [{"name": "Str", "amount": 9}], "scalesWith": [{"name": "Str", "scaling": "d"}]}, "junk", {"id": "w2"}]}
    pages = spark.createDataFrame([(1, json.dumps(body)), (2, None), (3, "broken"), (4, '{"data": null}')], "page_id long, body string")
    fields = "id string, name string, category string, weight string, attack string, requiredAttributes string, scalesWith string"
    items = readers.envelope(pages, fields, keep=["page_id"])
    assert rows(items.select("page_id", "item_no", "id")) == [(1, 0, "w1"), (1, 2, "w2")]
    w = records.load(items, "weapons", "github_api", "api").collect()
    assert len(w) == 1
    assert (w[0]["damage_physical"], w[0]["required_str"], w[0]["scaling_str"], w[0]["scaling_dex"], w[0]["weapon_type"], w[0]["source_priority"], w[0]["weight"]) == (113.0, 9, "D", "-", "sword", 3, 5.5)


def test_other_domains(spark):
    dlc = spark.createDataFrame([("7", "Twin", "Twinblade", '{"Str": 12}')], "weapon_id string, name string, category string, requirements string")
    got = records.load(dlc, "weapons", "kaggle_dlc", "dlc").first()
    assert (got["is_dlc"], got["weapon_type"], got["required_str"], got["source_priority"], got["source_id"]) == (True, "spear", 12, 1, "7")
    armor = spark.createDataFrame([("1", "Hood", "Helm", '[{"name": "Phy", "amount": 6.8}]', '[{"name": "Imm.", "amount": 70}]', "0")], "id string, name string, category string, dmgNegation string, resistance string, dlc string")
    a = records.load(armor, "armor", "b", "base").first()
    assert (a["armor_type"], a["defense_physical"], a["resistance_immunity"], a["is_dlc"]) == ("head", 6.8, 70, False)
    items = spark.createDataFrame([("1", "Pot", "Consumable", "rare", "1,000", '["a", "b"]')], "id string, name string, type string, rarity string, sellPrice string, obtainedFrom string")
    i = records.load(items, "items", "a", "api").first()
    assert (i["category"], i["rarity"], i["sell_price"]) == ("consumable", "rare", 1000)
    boss = spark.createDataFrame([("1", "Margit", "Limgrave", "1,800", ["x", "y"])], "id string, name string, region string, healthPoints string, drops array<string>")
    assert records.load(boss, "bosses", "a", "api").first()["health_points"] == 1800
    spell = spark.createDataFrame([("1", "Comet", "Sorceries", "24", "1", '[{"name": "Intelligence", "amount": 10}]')], "id string, name string, type string, cost string, slots string, requires string")
    s = records.load(spell, "spells", "a", "api").first()
    assert (s["spell_type"], s["required_int"], s["fp_cost"]) == ("sorcery", 10, 24)
    with pytest.raises(ValueError, match="domain"):
        records.load(spell, "horses", "a", "api")


HTML = """<html><script>var x = "<p>no</p>";</script><h2>WeaponName_dlc01.fmg</h2><h3>Blade [10]</h3><p>A &amp; blade.</p><p>Of old.</p><h3>Last [11]</h3><p>Kept.</p>
<h2>TalkMsg.fmg</h2><p>[500] Speaker</p><p>Hello there.</p><h4>Term</h4><p>A longer definition.</p><table><tr><th>Name</th><td>Some longer text</td></tr></table><dl><dt>Word</dt><dd>Its long meaning</dd></dl></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "<p>lost")], "page_id long, html string")
    got = rows(readers.html_entries(pages).select("section", "category", "entry_id", "name", "text"))
    assert got[0] == ("TalkMsg.fmg", "npc", "500", "Speaker", "Hello there.\nA longer definition.")
    assert got[1:] == [("WeaponName_dlc01.fmg", "weapon", "10", "Blade", "A & blade.\nOf old."), ("WeaponName_dlc01.fmg", "weapon", "11", "Last", "Kept.")]
    pairs = rows(readers.html_pairs(pages).select("section", "name", "text"))
    assert pairs == [("TalkMsg.fmg", "Name", "Some longer text"), ("TalkMsg.fmg", "Term", "A longer definition."), ("TalkMsg.fmg", "Word", "Its long meaning")]


def test_yaml_aliases_answers(spark, tmp_path):
    (tmp_path / "m.yml").write_text("categories:\n- slug: decay\n  label: Decay\n  motifs:\n  - slug: rot\n    label: Rot\n    synonyms: [decay]\n    narrative_signals: [wither]\n    canonical_examples: [Malenia]\n")
    (m,) = readers.motifs_from_yaml(str(tmp_path / "m.yml"))
    assert (m.slug, m.keywords, m.examples, m.category) == ("rot", ("Rot", "decay", "wither"), ("Malenia",), "decay")
    (tmp_path / "w.yml").write_text("Lore: 2\nnew: 0.5\n")
    w = readers.weights_from_yaml(str(tmp_path / "w.yml"), lore.WEIGHTS)
    assert (w["lore"], w["new"], w["quote"]) == (2.0, 0.5, 1.3)
    (tmp_path / "w.yml").write_text("lore: high\n")
    with pytest.raises(ValueError, match="number"):
        readers.weights_from_yaml(str(tmp_path / "w.yml"), {})
    (tmp_path / "b" / "one").mkdir(parents=True)
    (tmp_path / "b" / "one" / "bundle.yml").write_text("bundle: {id: b1, operation: upsert, updated_at: '2024-01-02T00:00:00Z'}\nannotation: {id: a1, text: hi}\nrevisions: [{version: 1}]\n")
    b = readers.read_bundles(spark, str(tmp_path / "b")).first()
    assert (b["annotation_id"], b["operation"], b["updated_at"], len(b["checksum"])) == ("a1", "upsert", datetime(2024, 1, 2), 64)
    (tmp_path / "al.csv").write_text("alias,target\n a ,x\na,y\n,z\n")
    assert rows(readers.read_aliases(spark, str(tmp_path / "al.csv"))) == [("a", "y")]
    answer = {"custom_id": "e1", "response": {"body": {"output": [{"content": [{"text": 'Here: {"summary_text": "s"}'}]}]}}}
    (tmp_path / "r.jsonl").write_text(json.dumps(answer) + "\n\nbroken\n" + json.dumps({"custom_id": "e2", "response": {}}) + "\n")
    got = readers.read_answers(spark, str(tmp_path / "r.jsonl"))
    assert sorted((r["custom_id"] or "", r["ok"]) for r in got.collect()) == [("", False), ("e1", True), ("e2", False)]
    assert readers.answer_diagnostics(got).first() == (1, 2)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("weapon", "a", True, ["s1", "s2"], {"k": "v"}), ("boss", "b", None, ["s1"], None)], "entity_type string, slug string, is_dlc boolean, sources array<string>, meta map<string,string>")
    assert rows(writers.flat(df).select("slug", "sources", "meta")) == [("a", '["s1","s2"]', '{"k":"v"}'), ("b", '["s1"]', "{}")]
    writers.export_by_type(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/parquet")).where("entity_type = 'boss'").count() == 1
    assert writers.metadata(df) == {"total": 2, "dlc": 1, "base": 1, "by_type": {"weapon": 1, "boss": 1}, "by_source": {"s1": 2, "s2": 1}}
    writers.write_lineage(df, str(tmp_path / "lineage"))
    assert spark.read.json(str(tmp_path / "lineage")).count() == 2
    writers.quality_report(profile.profile(df.select("slug")), "T <x>", str(tmp_path / "q" / "r.html"))
    assert "T &lt;x&gt;" in (tmp_path / "q" / "r.html").read_text()
    assert json.loads((tmp_path / "q" / "r.json").read_text())["columns"][0]["n_rows"] == 2
    writers.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    request = json.loads(writers.batch_requests(df.select("slug"), "slug", "m", "do").first()["request"])
    assert (request["custom_id"], request["body"]["model"]) == ("a", "m")
    edges = spark.createDataFrame([("speaks", "entity:a&", "lore:1", 1)], "kind string, src string, dst string, weight long")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).withColumn("node_type", F.lit("x"))
    writers.write_graph(nodes, edges, str(tmp_path / "g"))
    writers.write_graphml(nodes, edges, str(tmp_path / "g.xml"))
    assert "entity:a&amp;" in (tmp_path / "g.xml").read_text()
    with pytest.raises(ValueError, match="edges"):
        writers.write_graphml(nodes, edges, str(tmp_path / "h.xml"), most=0)
    assert writers.markdown(edges).splitlines()[0] == "| kind | src | dst | weight |"
    assert records.in_order(df, ["slug", "extra"]).columns[:2] == ["slug", "extra"]


def run(stream, spark, name, mode="append"):  # noqa: ANN001, ANN201
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_streams(spark, tmp_path):
    schema = "k string, at timestamp, v string, gone boolean"
    first = [("a", datetime(2024, 1, 1), "1", False), ("a", datetime(2024, 1, 3), "2", False), ("b", datetime(2024, 1, 2), "x", True)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(str(tmp_path / "in/1"))
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {(r["key"], r["value"]): r["outcome"] for r in run(streams.latest_state(source, "k", "at", "v", "gone"), spark, "latest").collect()}
    assert got == {("a", "1"): "created", ("a", "2"): "updated", ("b", "x"): "deleted"}
    assert run(streams.once(source, ["k"], "at", "10 days"), spark, "once").count() == 2
    assert run(streams.replayed(source, "at", F.expr("TIMESTAMP '2024-01-02'")), spark, "replayed").count() == 2
    assert run(streams.windowed_counts(source, "at", "7 days", "1 day", ["k"]), spark, "counts", "complete").count() == 2
    seen: list[int] = []
    for _ in range(2):
        q = streams.each_batch(source, str(tmp_path / "manifest"), ["k"], lambda df: seen.append(df.count())).start()
        q.processAllAvailable()
        q.stop()
    assert seen == [2, 0]
