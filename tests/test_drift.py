"""Schema drift: fixtures by hand, and a brute-force version over random files."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from corpusloom.operators import drift

from .conftest import rows

FILES = "file_id long, feed_id string, exported_at timestamp, extra string"
RECORDS = "record_id long, file_id long, payload string, feed_id string"
T0 = datetime(2024, 1, 1)


def tables(spark, files):  # noqa: ANN001, ANN201
    """files: (file_id, feed, day, [payload or text])."""
    f = spark.createDataFrame([(i, feed, None if day is None else T0 + timedelta(days=day), "x") for i, feed, day, _ in files], FILES)
    r, n = [], 0
    for i, _, _, payloads in files:
        for p in payloads:
            n += 1
            r.append((n, i, p if p is None or isinstance(p, str) else json.dumps(p), "clash"))
    return f, spark.createDataFrame(r, RECORDS)


def found(spark, files):  # noqa: ANN001, ANN201
    return rows(drift.changes(*tables(spark, files)).select("file_id", "change_kind", "field_name"))


def items(**by_field):  # noqa: ANN003, ANN201
    n = max(len(v) for v in by_field.values())
    return [{"id": f"i{k}", **{f: v[k] for f, v in by_field.items() if v[k] != "absent"}} for k in range(n)]


def test_added_removed_retyped(spark):
    a = items(name=["x", "y"], weight=[1.5, 2])
    b = items(name=["x", "y"], weight=["1.5", "2"], note=["n", "m"])
    c = items(name=["x", "y"], note=["n", "m"])
    got = found(spark, [(5, "f", 1, a), (3, "f", 2, b), (9, "f", 3, c)])
    assert got == [(3, "added", "note"), (3, "retyped", "weight"), (9, "removed", "weight")]


def test_renamed_with_new_type_and_form(spark):
    a = items(scales=[[{"name": "Str", "scaling": "A"}], [{"name": "Dex", "scaling": "B"}]], dlc=["True", "False"])
    b = items(scalesWith=[{"Str": "A"}, "[{'name': 'Dex', 'scaling': 'B'}]"], isDlc=[1, 0])
    got = found(spark, [(1, "f", 1, a), (2, "f", 2, b)])
    assert got == [(2, "renamed", "isDlc"), (2, "renamed", "scalesWith"), (2, "retyped", "isDlc"), (2, "retyped", "scalesWith")]


def test_unrelated_fields_are_not_renamed(spark):
    got = found(spark, [(1, "f", 1, items(old=["a", "b", "c"])), (2, "f", 2, items(new=["p", "q", "r"]))])
    assert got == [(2, "added", "new"), (2, "removed", "old")]


def test_order_nulls_broken_and_repeats(spark):
    a = items(x=[1, 2])
    files = [
        (4, "f", None, a),  # before the dated ones
        (2, "f", 1, [*a, *a, None, "", "not json", "[1]", '{"id": "i0", "x": null, "z": null}']),
        (1, "f", 1, a),  # the same time: by id, so before 2
        (7, None, 1, a),
        (8, None, 2, [{"id": "i0", "y": "other"}]),
        (9, "g", 5, []),
    ]
    assert found(spark, files) == [(8, "added", "y"), (8, "removed", "x")]


def test_file_without_records(spark):
    got = found(spark, [(1, "f", 1, items(x=[1])), (2, "f", 2, []), (3, "f", 3, items(x=[1]))])
    assert got == [(2, "removed", "id"), (2, "removed", "x"), (3, "added", "id"), (3, "added", "x")]


def test_majority_type_and_empty_tables(spark):
    a = items(v=["a", "b", 3])
    b = items(v=[1, "b", 3])
    assert found(spark, [(1, "f", 1, a), (2, "f", 2, b)]) == [(2, "retyped", "v")]
    f, r = tables(spark, [])
    assert rows(drift.changes(f, r)) == []
    assert drift.unified(f, r).count() == 0


@pytest.mark.parametrize(("a", "b", "joined"), [("number", "boolean", "number"), ("array", "object", "array"), ("string", "number", "string"), (None, "array", "array"), ("boolean", "object", "string")])
def test_lattice(a, b, joined):
    assert drift.promote(a, b) == drift.promote(b, a) == joined


def test_unified_table_and_log(spark):
    a = items(dmgNegation=[3, 4], dlc=[True, False])
    b = items(dmg_neg=[3, 4], dlc=[0, 1], other=["t", "u"])
    f, r = tables(spark, [(1, "f", 1, a), (2, "f", 2, b)])
    wide = drift.unified(f, r)
    assert [c for c in wide.columns if c.startswith("f_")] == ["f_dlc", "f_dmg_negation", "f_id", "f_other"]
    assert rows(wide.select("record_id", "f_dmg_negation", "f_dlc", "f_other")) == [(1, 3.0, 1.0, None), (2, 4.0, 0.0, None), (3, 3.0, 0.0, "t"), (4, 4.0, 1.0, "u")]
    log = drift.change_log(f, r).select("step", "change_kind", "field_name", "old_name").collect()
    assert sorted(map(tuple, log)) == [(1, "added", "other", None), (2, "renamed", "dmg_neg", "dmgNegation"), (3, "retyped", "dlc", None)]
    with pytest.raises(ValueError, match="columns"):
        drift.unified(f, r, max_columns=2)


def brute(files):  # noqa: ANN001, ANN201
    """The same by plain loops."""
    out = set()
    feeds: dict = {}
    for f in files:
        feeds.setdefault(f[1], []).append(f)
    kind = {str: "string", int: "number", float: "number", bool: "boolean", list: "array", dict: "object"}
    for members in feeds.values():
        members.sort(key=lambda f: (f[2], f[0]))
        before = None
        for file_id, _, _, payloads in members:
            types: dict = {}
            values: dict = {}
            for p in payloads:
                for k, v in p.items():
                    if v is not None:
                        types.setdefault(k, Counter())[kind[type(v)]] += 1
                        values.setdefault(k, {})[p["id"]] = drift._plain(v)
            now = {k: max(c, key=lambda t: (c[t], -drift.TYPES.index(t))) for k, c in types.items()}
            if before is not None:
                old, old_values = before
                gone, come = set(old) - set(now), set(now) - set(old)
                for g in sorted(gone):
                    for c in sorted(come):
                        both = set(old_values[g]) & set(values[c])
                        if both and sum(old_values[g][i] == values[c][i] for i in both) / len(both) >= 0.5:
                            out.add((file_id, "renamed", c))
                            if old[g] != now[c]:
                                out.add((file_id, "retyped", c))
                            gone, come = gone - {g}, come - {c}
                            break
                out |= {(file_id, "added", c) for c in come} | {(file_id, "removed", g) for g in gone}
                out |= {(file_id, "retyped", k) for k in set(now) & set(old) if now[k] != old[k]}
            before = (now, values)
    return sorted(out, key=lambda r: [str(x) for x in r])


def test_random_files_against_brute_force(spark):
    rng = random.Random(5)
    files, n = [], 0
    for feed in range(6):
        names = {p: p for p in ("alpha", "beta", "gamma", "delta", "eps")}
        forms = {p: rng.randrange(3) for p in names}
        for day in range(7):
            n += 1
            p = rng.choice(list(names))
            step = rng.randrange(4)
            if step == 0:
                names[p] = f"{p}_{n}"
            elif step == 1:
                forms[p] = rng.randrange(3)
            left_out = rng.choice([*names, "none", "none"])
            payloads = []
            for i in range(12):
                row: dict = {"id": f"{feed}-{i}"}
                for q, name in names.items():
                    if q != left_out and rng.random() > 0.1:
                        value = f"{q}{i}"
                        row[name] = [value, [value], {"name": value, "amount": 1}][forms[q]]
                payloads.append(row)
            files.append((n, f"feed{feed}", day, payloads))
    assert [tuple(map(str, r)) for r in found(spark, files)] == [tuple(map(str, r)) for r in brute(files)]


def test_no_value_is_lost(spark):
    f = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "file_id long, feed_id string, exported_at timestamp")
    rows = [(1, 1, '{"id": "x", "w": 1}'), (2, 1, '{"id": "y", "w": 2}'), (3, 1, '{"id": "z", "w": "heavy", "scalesWith": "A", "scales_with": "B"}')]
    r = spark.createDataFrame(rows, "record_id long, file_id long, payload string")
    wide = {x["record_id"]: x for x in drift.unified(f, r).collect()}
    assert [wide[i]["f_w"] for i in (1, 2, 3)] == ["1", "2", "heavy"]
    assert wide[3]["f_scales_with"] == "B"
    assert [(x["record_id"], x["field_name"], x["value"]) for x in drift.displaced(f, r).collect()] == [(3, "scalesWith", "A")]
    assert drift.unified_long(f, r).count() == 9 - 1
