"""Scalar functions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import similarity as S
from corpusloom.functions import text as T
from corpusloom.functions import values as V


def one(spark, column, **values):  # noqa: ANN001, ANN003, ANN201
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "slug"), [("Rivers of Blood", "rivers_of_blood"), ("Ordovis's Greatsword", "ordoviss_greatsword"), ("  Élan -- Vital! ", "élan_vital"), ("", ""), (None, None), ("a b", "a_b")])
def test_slug(spark, text, slug):
    assert one(spark, T.slug("t"), t=text) == slug


def test_names_and_texts(spark):
    assert one(spark, T.match_name("t"), t="  Moonveil (Katana)  +3 ") == "moonveil katana 3"
    assert one(spark, T.lore_text("t"), t=" a  b\r\n\r\n\r\nc\t\td ") == "a b\nc d"
    assert one(spark, T.lore_text("t"), t=None) == ""
    assert one(spark, T.collapse_blank_lines("t"), t=" a \n\n\n b\r\nc ") == "a\n\nb\n\nc".replace("\n\nc", "\nc")
    assert one(spark, T.query_text("t"), t="“Don’t”  –  GO ") == "\"don't\" - go"
    assert one(spark, T.section("k", "t"), k="impalers_excerpt", t=" x ") == "Impalers Excerpt:\nx"
    assert one(spark, T.section("k", "t"), k="", t="x") == "Text:\nx"
    assert one(spark, T.section("k", "t"), k="lore", t="  ") == ""


@pytest.mark.parametrize(
    ("weight", "want"),
    [(0.0, ""), (-1.0, ""), (0.7, "a b c d e f g"), (0.01, "a"), (1.0, "a b c d e f g h i j"), (1.4, "a b c d e f g h i j\n\na b c"), (2.5, "a b c d e f g h i j\n\na b c d e f g h i j\n\na b c d e")],
)
def test_scale_block(spark, weight, want):
    assert one(spark, T.scale_block("t", F.col("w")), t=" a b c d e f g h i j ", w=weight) == want


def test_lists_keywords_handles(spark):
    lists = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (["a", "b", "c"],)], "a array<string>")
    assert [r["x"] for r in lists.select(T.listed("a").alias("x")).collect()] == ["", "a", "a and b", "a, b and c"]
    assert one(spark, T.any_keyword("t", ["rot"]), t="Protect")
    assert not one(spark, T.any_keyword("t", ["rot"], whole_words=True), t="Protect")
    assert one(spark, T.any_keyword("t", ["a.b", ""]), t="xA.By")
    assert one(spark, T.any_keyword("t", ["x"]), t=None) is False
    assert one(spark, T.any_keyword("t", []), t="x") is False
    assert [one(spark, T.handle_ok("t"), t=h) for h in ("ab", "a", "A_b", "a-b_9", "x" * 40, None)] == [True, False, False, True, False, False]
    assert T.snake_name("Weapon Type-Name") == "weapon_type_name"
    assert T.snake_name("dmgNegation") == "dmg_negation"
    assert T.plain_column_name(" Required STR (%) ") == "required_str_"


def test_numbers_and_flags(spark):
    assert [one(spark, V.safe_float("t"), t=x) for x in ("1,200.5", " 3 ", "x", "", None)] == [1200.5, 3.0, None, None, None]
    assert [one(spark, V.safe_int("t"), t=x) for x in ("1,200.9", "-3.9", "x", "1e30", None)] == [1200, -3, None, None, None]
    assert [one(spark, V.flag("t"), t=x) for x in ("1", "TRUE", "0", "False", "", "maybe", None)] == [True, True, False, False, False, None, None]
    assert one(spark, V.first_filled("a", "b", "c"), a=" ", b=None, c=" x ") == "x"
    assert one(spark, V.merged_text("a", "b", "c"), a="x", b="NaN", c="y") == "x\n\ny"
    assert one(spark, V.labelled_text({"a": "A", "b": "B"}), a="x", b="y") == "A: x\n\nB: y"
    assert one(spark, V.labelled_text({"a": "A", "b": "B"}), a="x", b=None) == "x"
    assert str(one(spark, V.iso_time("t").cast("string"), t="2024-01-02T03:04:05Z")) == "2024-01-02 03:04:05"


def test_structures(spark):
    assert one(spark, V.structured_json("t"), t="{'a': None, 'b': True}") == '{"a": null, "b": true}'
    assert one(spark, V.structured_json("t"), t="nothing [") is None
    found = lambda t: [(e["name"], e["amount"]) for e in one(spark, V.entries("t"), t=t)]
    assert found('[{"name": "Phy", "amount": 113}]') == [("Phy", "113")]
    assert found("[{'name': 'Phy', 'amount': 113}]") == [("Phy", "113")]
    assert found('{"Str": 12}') == [("Str", "12")]
    assert found("-") == []
    assert one(spark, V.structured_text("t"), t='[{"name": "a", "amount": 1}, {"name": "b"}]') == "a: 1; b"
    assert one(spark, V.structured_text("t"), t='{"k": "v"}') == "k: v"
    assert one(spark, V.structured_text("t"), t=" plain ") == "plain"
    assert one(spark, V.repaired_json("t"), t='Sure: {"a": 1} ok') == '{"a": 1}'


def test_pivots(spark):
    e = V.entries("t")
    assert one(spark, V.damage(e)["damage_lightning"], t='[{"name": "Ligt", "amount": 5}, {"name": "lit", "amount": "7"}]') == 7.0
    assert one(spark, V.requirements(e)["required_str"], t='{"Str": 12}') == 12
    assert one(spark, V.scaling(e)["scaling_dex"], t='[{"name": "Dex", "scaling": "d "}]') == "D"
    assert one(spark, V.scaling(e)["scaling_arc"], t="[]") == "-"
    assert one(spark, V.negations(e)["defense_strike"], t='[{"name": "VS Str.", "amount": -3}]') == 0.0
    assert one(spark, V.resistances(e)["poise"], t='{"Poi.": 35}') == 35


def test_vocabularies(spark):
    assert [one(spark, V.weapon_type("t"), t=x) for x in ("Straight-Swords", "Twinblade", "Katana", None, "Great Axes")] == ["sword", "spear", "other", "other", "axe"]
    assert [one(spark, V.armor_type("t"), t=x) for x in ("Helm", "Chest Armor", "Greaves", "Robe", None)] == ["head", "arms", "legs", "chest", "other"]
    assert one(spark, V.armor_type("t", chest_first=True), t="Chest Armor") == "chest"
    assert [one(spark, V.item_category("t"), t=x) for x in ("Key_Item", "Great Rune of X", "  ", None, "zzz")] == ["key_item", "key_item", "other", "other", "other"]
    assert [one(spark, V.rarity("t"), t=x) for x in (" Rare", "mythic", None)] == ["rare", None, None]
    assert [one(spark, V.categorical("t", {"mag": "magic"}), t=x) for x in (" MAG ", "x", None)] == ["magic", "x", "nan"]
    assert [one(spark, V.entity_type_of("t"), t=x) for x in ("bosses", "weapons", "Sorceries")] == ["boss", "weapon", "sorcery"]


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_ratio(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choice("abcé ") for _ in range(rng.randrange(12))), "".join(rng.choice("abcé ") for _ in range(rng.randrange(12)))) for _ in range(150)] + [("", ""), ("radahn", "starscourge radahn")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", S.ratio("a", "b").alias("r"), S.batch_ratio("a", "b").alias("q"), S.ratio_possible("a", "b", 0.8).alias("p")).collect()
    for r in got:
        want = 2 * lcs(r["a"], r["b"]) / (len(r["a"]) + len(r["b"])) if r["a"] or r["b"] else 1.0
        assert r["r"] == pytest.approx(want)
        assert r["q"] == pytest.approx(want)
        assert r["p"] or want < 0.8


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<double>")
    got = df.select(S.dot("a", "b").alias("d"), S.norm("a").alias("n"), S.l2_distance("a", "b").alias("l"), S.normalized("a").alias("u")).collect()
    assert (got[0]["d"], got[0]["n"], got[0]["u"]) == (24.0, 5.0, [0.6, 0.8])
    assert got[0]["l"] == pytest.approx(2**0.5)
    assert got[1]["u"] == [0.0, 0.0]
