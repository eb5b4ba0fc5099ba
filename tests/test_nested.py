"""Nested records: the structural index against a parser, and the entries' rules."""

from __future__ import annotations

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import nested

from .conftest import rows

json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-999, 999) | st.floats(allow_nan=False, allow_infinity=False, width=32) | st.text(max_size=12) | st.sampled_from(['"', "\\", '\\"', "{}", "[,]:", "é\U0001f480"]),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=6) | st.sampled_from(["a", 'k"', "k\\"]), inner, max_size=4),
    max_leaves=25,
)


def rebuilt(x: nested.Index, i: int) -> object:
    """Value of an element, from its spans and links only."""
    kind = chr(x.bytes[x.start[i]])
    if kind not in "{[":
        return json.loads(x.text(i))
    own = sorted((j for j in range(len(x.start)) if x.holder[j] == i), key=lambda j: x.ordinal[j])
    assert [x.ordinal[j] for j in own] == list(range(len(own)))
    if kind == "[":
        return [rebuilt(x, j) for j in own]
    return {json.loads(x.raw[x.key_start[j] : x.key_end[j]]): rebuilt(x, j) for j in own}


@settings(max_examples=150, deadline=None)
@given(st.lists(json_values, min_size=1, max_size=4), st.sampled_from([None, 1, "\t"]), st.booleans())
def test_index_holds_the_whole_value(values, indent, ascii_only):
    texts = [json.dumps(v, indent=indent, ensure_ascii=ascii_only).encode() for v in values]
    x = nested.Index(texts)
    assert [rebuilt(x, d) for d in range(len(values))] == values
    for d in range(len(values)):
        assert x.text(d).strip() == texts[d].strip()


def pages(spark, bodies):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(i + 1, b, "other") for i, b in enumerate(bodies)], "page_id long, body string, item_no string")


def test_entries_by_hand(spark):
    body = {
        "success": True,
        "data": [
            {"attack": [{"name": " Phy", "amount": "1,200"}, {"name": "", "amount": 3}, {"name": "Mag"}, {"amount": 4}, {"name": "FIRE", "amount": 80.0, "note": "x"}]},
            "no object",
            {
                "attack": {"name": "Holy", "amount": " 259"},
                "requiredAttributes": "[{'name': 'Str', 'amount': 12}]",
                "scalesWith": '[{"name": "Dex", "scaling": "b "}, {"name": "Int", "scaling": null}]',
                "variants": [None, {"attack": {"Crit": 110, "x": None}, "upgrades": [{"scalesWith": [{"name": "Arc", "scaling": "s"}]}, {"attack": None}], "variants": [{"attack": {"no": 1}}]}],
            },
            {"attack": "-", "requiredAttributes": "", "scalesWith": [], "variants": {"attack": {"no": 1}}},
        ],
        "other": {"data": [{"attack": {"no": 1}}]},
    }
    got = rows(nested.entries(pages(spark, [json.dumps(body, indent=1)])))
    assert got == sorted(
        [
            (1, 0, -1, -1, "attack", 0, "phy", "1200"), (1, 0, -1, -1, "attack", 4, "fire", "80"), (1, 2, -1, -1, "attack", 0, "holy", "259"),
            (1, 2, -1, -1, "requiredAttributes", 0, "str", "12"), (1, 2, -1, -1, "scalesWith", 0, "dex", "B"), (1, 2, 1, -1, "attack", 0, "crit", "110"),
            (1, 2, 1, 0, "scalesWith", 0, "arc", "S"),
        ],
        key=lambda r: [(x is not None, str(x)) for x in r],
    )


def test_null_blank_broken_and_empty(spark):
    bodies = [None, "", "  \n", '{"data": [', "{'data': []}", "[]", "3", '{"data": null}', '{"data": []}', '{"data": [{}]}', '{"data": {"attack": {"a": 1}}}']
    assert rows(nested.entries(pages(spark, bodies))) == []
    assert nested.flatten(pages(spark, [])).count() == 0


def test_repeated_pages_keys_and_escapes(spark):
    body = '{"data": [{"attack": {"a": 1}, "att\\u0061ck": {"b\\"]": 2}}]}'
    got = rows(nested.entries(pages(spark, [body, body])))
    assert got == [(1, 0, -1, -1, "attack", 0, 'b"]', "2"), (2, 0, -1, -1, "attack", 0, 'b"]', "2")]


def test_long_and_deep(spark):
    deep = '{"data": [{"attack": {"a": 7}, "x": ' + "[" * 300 + "]" * 300 + ', "y": "' + "{[,:" * 50_000 + '"}]}'
    assert rows(nested.entries(pages(spark, [deep]))) == [(1, 0, -1, -1, "attack", 0, "a", "7")]


def test_flat_tables_and_links(spark):
    body = json.dumps({"data": [{"id": "w", "n": 2, "variants": [{"affinity": "Keen", "upgrades": [{"level": 3}]}]}]})
    p = pages(spark, [body])
    assert rows(nested.level_rows(p, "data").select("item_no", "fields")) == [(0, {"id": "w", "n": "2"})]
    assert rows(nested.level_rows(p, "upgrades").drop("page_id")) == [(0, 0, 0, {"level": "3"})]
    nodes = nested.flatten(p)
    assert nodes.count() == 11
    ids = {r["node_id"]: r for r in nodes.collect()}
    level = next(r for r in ids.values() if r["name"] == "level")
    path = []
    while level is not None:
        path.append(level["name"])
        level = ids.get(level["parent_id"])
    assert path == ["level", None, "upgrades", None, "variants", None, "data", None]


def test_depth_and_constants():
    assert nested.is_json("[" * 100_000 + "]" * 100_000)
    assert nested.is_json('{"a": [' * 50_000 + "1" + "]}" * 50_000)
    for bad in ("[" * 100_000 + "]" * 99_999, "[" * 50_000 + "1,]" + "]" * 49_999, "[" * 50_000 + '{"a" 1}' + "]" * 50_000, "[NaN]", "[Infinity]", "-Infinity"):
        assert not nested.is_json(bad)


def test_deep_field_and_large_amounts(spark):
    deep = "[" * 30_000 + "]" * 30_000
    body = '{"data": [{"attack": [{"name": "Phy", "amount": 9007199254740993}, {"name": "Mag", "amount": ' + deep + '}, {"name": "Fire", "amount": "1,204"}]}]}'
    df = spark.createDataFrame([(1, body)], "page_id long, body string")
    assert [(r["entry_no"], r["entry_name"], r["entry_value"]) for r in nested.entries(df).orderBy("entry_no").collect()] == [(0, "phy", "9007199254740993"), (2, "fire", "1204")]
    assert nested.flatten(df).count() == 1 + 1 + 1 + 1 + 3 + 6 + 30_000 - 1
