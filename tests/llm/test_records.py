"""Matching, survivors and canonical mapping."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("corpusloom.llm")

from corpusloom.llm import canonical, matching, survivor  # noqa: E402
from corpusloom.session import released, shared_folder  # noqa: E402

from ..conftest import rows  # noqa: E402

ENTITY = "record_id long, match_key string, name string, description string, weight double, effect string, obtained_from string, source_priority int, updated_at timestamp, value string, _key string"


def day(n: int) -> datetime:
    return datetime(2024, 1, n)


def survivors(spark, data):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(*r, "x", "y") for r in data], ENTITY)
    return rows(survivor.survivors(df, "match_key", survivor.entity_rules()).select("match_key", "field_name", "record_id"))


def test_survivor_by_rule(spark):
    got = survivors(
        spark,
        [
            (1, " Key ", "A", "short", 0.0, "nan", "here", 2, day(3)),
            (2, "key", "B", " much longer ", 5.0, "  ", "there", 1, day(1)),
            (3, "KEY", "C", "much longer", float("nan"), "Burns", "N/A", None, day(9)),
            (4, "key", " Unknown ", None, None, "Burns", None, 1, None),
            (5, None, "D", "d", 1.0, "e", "f", 1, day(1)),
            (6, "alone", "D", "d", 1.0, "e", "f", 1, day(1)),
        ],
    )
    assert got == [("key", "description", 2), ("key", "effect", 4), ("key", "name", 2), ("key", "obtained_from", 1), ("key", "weight", 2)]


def test_survivor_ties_and_nothing_usable(spark):
    same = ("k", "A", "text", 1.0, "e", "o", 1, day(1))
    assert {r[2] for r in survivors(spark, [(9, *same), (4, *same), (7, *same)])} == {4}
    assert survivors(spark, [(1, "k", None, "-", -1.0, "NULL", "none", 1, None), (2, "k", "", " ", float("inf"), None, "n/a", 1, None)]) == []
    assert survivors(spark, []) == []


def test_golden_and_currency(spark):
    data = []
    n = 0
    for g in range(6):  # everywhere "mill" was followed by "tower"
        for v, d in (("mill", 1), ("tower", 5)):
            n += 1
            data.append((n, f"g{g}", "N", "d", 1.0, "e", v, 1, day(d), "x", "y"))
    data += [(50, "late", "N", "d", 1.0, "e", "mill", 1, day(2), "x", "y"), (51, "late", "N", "d", 1.0, "e", "tower", 1, None, "x", "y")]
    data += [(60, "early", "N", "d", 1.0, "e", "tower", 1, day(2), "x", "y"), (61, "early", "N", "d", 1.0, "e", "mill", 1, None, "x", "y")]
    data += [(70, "no date", "N", "d", 1.0, "e", "z", 1, None, "x", "y"), (71, "no date", "N", "d", 1.0, "e", "a", 1, None, "x", "y")]
    df = spark.createDataFrame(data, ENTITY)
    got = {r["match_key"]: (r["value"], r["reason"]) for r in survivor.currency_latest(df, "match_key", "obtained_from", survivor.usable_text("obtained_from")).collect()}
    assert got["late"] == ("tower", "learned")
    assert got["early"] == ("tower", "dated")
    assert got["no date"] == ("a", "undated")
    gold = {r["match_key"]: r for r in survivor.golden(df, "match_key", survivor.entity_rules()).collect()}
    assert (gold["g0"]["obtained_from"], gold["g0"]["n_records"]) == ("tower", 2)


def test_currency_follows_chains(spark):
    data = []

    def put(group, value, date=None):  # noqa: ANN001, ANN202
        data.append((len(data), group, "N", "d", 1.0, "e", value, 1, date and day(date), "x", "y"))

    for g in range(3):
        for x, y in (("a", "b"), ("b", "c")):
            put(f"{x}{y}{g}", x, 1)
            put(f"{x}{y}{g}", y, 5)
    for v in "aabc":
        put("no dates", v)
    put("chain", "a", 2)
    put("chain", "b")
    put("chain", "c")
    put("before", "c", 2)
    put("before", "a")
    put("dated later", "b", 2)
    put("dated later", "a", 3)
    put("dated later", "c")
    df = spark.createDataFrame(data, ENTITY)
    got = {r["match_key"]: (r["value"], r["reason"]) for r in survivor.currency_latest(df, "match_key", "obtained_from", survivor.usable_text("obtained_from")).collect()}
    assert got["no dates"] == ("c", "learned")
    assert got["chain"] == ("c", "learned")
    assert got["before"] == ("c", "dated")
    assert got["dated later"] == ("a", "dated")  # only b leads to c, and b is over


LISTED = [("npc:kleshoth", "Kleshoth the Gilded Warden", "npc"), ("boss:bispleichi", "Bispleichi", "boss"), ("item:chemakan", "Chemakan Zeissarn", "item"), ("npc:mouszes", "Mouszes, Hermit of the Ferry", "npc")]
PATTERNS = [("npc:carian_speaker_1*", "npc:a", 0.9), ("npc:carian_speaker_12*", "npc:b", None), ("npc:carian_speaker_1?3", "npc:c", 0.1), ("npc:carian_speaker_9", "npc:d", 0.2), ("npc:carian_speaker_*3", "npc:e", 1.0)]


def mapped(spark, raws, listed=LISTED):  # noqa: ANN001, ANN201
    a = spark.createDataFrame([(i, r, None, "x") for i, r in enumerate(raws)], "alias_id long, raw_id string, canonical_id string, name string")
    e = spark.createDataFrame(listed, "canonical_id string, name string, category string")
    p = spark.createDataFrame(PATTERNS, "raw_id string, canonical_id string, confidence double")
    got = {r["alias_id"]: r["canonical_id"] for r in canonical.map_aliases(a, e, p).collect()}
    assert len(got) == len(raws)
    return [got[i] for i in range(len(raws))]


def test_spellings(spark):
    raws = ["Kleshoth", "KLESHOTH the gilded warden", "Kl3shoth", "kleshothegildedwarden", "the Gilded Warden, Kleshoth", "Klesho.", "bispleichhi", "B1spleichi", "npc:bispleichi", "Mouszès", "Chemaka~", "Chmekan Zeissarn"]
    want = ["npc:kleshoth"] * 6 + ["boss:bispleichi"] * 3 + ["npc:mouszes", "item:chemakan", "item:chemakan"]
    assert mapped(spark, raws) == want


def test_unmatched_and_codes(spark):
    raws = [None, "", "  ", "???", "the gilded warden", "Hermit of the Ferry", "Woulozaeth of Masus", "x" * 20_000]
    assert mapped(spark, raws) == [canonical.UNMATCHED] * len(raws)
    codes = [" NPC:Carian_Speaker_155 ", "npc:carian_speaker_125", "npc:carian_speaker_113", "npc:carian_speaker_9", "npc:carian_speaker_99", "npc:carian_speaker_"]
    assert mapped(spark, codes) == ["npc:a", "npc:b", "npc:c", "npc:d", "unmatched", "unmatched"]
    assert mapped(spark, ["Kleshoth"], LISTED[:0]) == [canonical.UNMATCHED]
    assert mapped(spark, []) == []


def test_similar_words_are_exact(spark):
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(120)})
    df = spark.createDataFrame([(w, canonical.grams(w)) for w in words], "word string, grams array<bigint>")
    for t in (0.25, 0.5, 0.8, 1.0):
        got = {(r["left_word"], r["right_word"]) for r in canonical.similar_words(df, df, t).collect()}
        sets = {w: set(canonical.grams(w)) for w in words}
        assert got == {(a, b) for a in words for b in words if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t - 1e-12}


def test_distance():
    assert [canonical.distance(a, b, 9) for a, b in (("abc", "abc"), ("abc", "acb"), ("abcd", "abc"), ("abc", "xyz"), ("", "ab"))] == [0, 1, 1, 3, 2]
    assert canonical.distance("abcdef", "uvwxyz", 2) == 3


SOURCE = "entity_id long, source string, source_id string, entity_type string, name string, is_dlc boolean, description string, weight double, category string, id long"


def matched(spark, data):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(*r, 0) for r in data], SOURCE)
    return sorted((r["a"], r["b"]) for r in matching.match(df).collect())


def filler(n: int) -> list[tuple]:
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(["ba", "ko", "li", "mu", "re", "tsa", "vo", "xi"], 3))
    return [(10_000 + i, f"s{i % 4}", f"f{i}", "weapon", f"{word()} {word()} {word()}".title(), bool(i % 2), " ".join(word() for _ in range(14)), float(i % 37) + 0.5, f"c{i % 11}") for i in range(n)]


def test_pairs_of_one_thing(spark):
    say = "the marbled bell of old Kaldor counted nine winters beyond the silent harbor and returned at last with grief"
    data = [
        (1, "s0", "a", "weapon", "Greatsword of Kaldor Venn", False, say, 21.4, "reed"),
        (2, "s1", "b", "WEAPON", "kaldor_venn greatsword", None, say[:60], 21.44, None),
        (3, "s2", "c", "weapon", "Greatsw0rd of Kaldor Venn", True, None, 21.4, "reed"),
        (4, "s1", "d", "weapon", "Greatsword of Kaldor Venn (DLC)", True, "do you hear the kiln that sealed a tempered oath for those who woke too late in the fen", 33.0, "kiln"),
        (5, "s3", "e", "armor", "Greatsword of Kaldor Venn", False, say, 21.4, "reed"),
        (6, "s1", "f", "weapon", "Greatsword of Kaldor Venn", False, say, 21.4, "reed"),
        (7, "s1", "f2", "Weapon ", "Greatsword of Kaldor Venn", False, say, 21.4, " REED"),
    ]
    got = [p for p in matched(spark, [*data, *filler(300)]) if p[1] < 10_000]
    assert got == [(1, 2), (1, 3), (1, 6), (1, 7), (2, 3), (3, 6), (3, 7)]


def test_match_nulls_and_empty(spark):
    assert matched(spark, []) == []
    data = [(1, None, None, None, None, None, None, None, None), (2, "s1", None, None, "", None, "", None, None), (3, "s2", "x", "boss", "Solo", True, "y" * 30_000, 1.0, "z")]
    assert matched(spark, data) == []


def test_match_releases_what_is_over(spark, monkeypatch):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    held = lambda: {p.name for p in folder.glob("rdd-*")}
    before, left, rest = held(), [], matching.retrieved

    def counted(pairs, *args):  # noqa: ANN001, ANN002, ANN202
        for _ in range(10):
            released(spark)
            time.sleep(0.5)
            if len(held() - before) <= 1:
                break
        left.append(len(held() - before))
        return rest(pairs, *args)

    monkeypatch.setattr(matching, "retrieved", counted)
    matching.match(spark.createDataFrame([(*r, 0) for r in filler(60)], SOURCE))
    assert left == [1]  # the pairs; records and index are over


def test_logistic():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert matching.fit_logistic(x, y) == pytest.approx([2, -1, 0.5], abs=0.2)


def test_lengths_and_titles_come_from_the_tables(spark):
    long = "Kvelborastimunathrogdex"
    listed = [("item:axo", "Axo the Keen", "item"), ("boss:long", f"{long} of Tarn", "boss"), ("npc:mirdel", "Mirdel the Wise", "npc")]
    raws = ["axo", "AXO the keen", long.upper(), f"{long.lower()}oftarn", f"gate by the {long}"]
    titled = [f"Archon Mirdel {i}" for i in range(4)] + ["Archon Mirdil"]
    got = mapped(spark, [*raws, *titled], listed)
    assert got[:4] == ["item:axo", "item:axo", "boss:long", "boss:long"]
    assert got[4] == canonical.UNMATCHED
    assert got[5:] == ["npc:mirdel"] * 5
