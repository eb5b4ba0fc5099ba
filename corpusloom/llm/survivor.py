"""Best representative of each duplicate group: one surviving value per field, with the record it is from.

Each field has its own order of preference, made of criteria: trust (smallest priority), currency
(latest date) and completeness (longest text). The first record in that order that has a usable
value survives. All fields are decided in one map-side combined aggregate, min over a struct of
criteria, so that a group of any size is reduced where its rows lie and never gathered.

Currency of undated values (:func:`learn_transitions`, :func:`currency_latest`): from dated rows it is learned
which value tends to follow which. In a group, the latest dated value and all learned pairs among its values
give a partial order, whose topologically latest value is the current one, in groups without dates too.
Where a data set says that undated rows are the oldest, ``undated_oldest`` does that instead.

Defined cases: keys are compared trimmed and in lower case; null keys form no group; groups of
one row have no survivor (``least=2``); a field without usable value has no row; full ties go to the
smallest record id; NaN and infinite numbers aren't usable as weights; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that stand for a missing value.
PLACEHOLDERS = ("nan", "none", "null", "-", "n/a", "unknown")

#: White space at both ends, as a pattern; Unicode's kinds and the zero-width ones that are blank to a reader of str.strip.
_ENDS = r"^[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$"


def trimmed(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(text, _ENDS, "")


def usable_text(name: str) -> Column:
    """Whether a text says something: not null, blank or a placeholder."""
    t = F.lower(trimmed(F.col(name)))
    return F.col(name).isNotNull() & (t != "") & ~t.isin(*PLACEHOLDERS)


def usable_weight(name: str) -> Column:
    """Whether a number is a weight: above 0 and finite."""
    return F.col(name).isNotNull() & ~F.isnan(name) & (F.col(name) > 0) & (F.col(name) < float("inf"))


@dataclass(frozen=True)
class Rule:
    """How the survivor of a field is chosen: which values are usable and the criteria, each the smaller the better."""

    usable: Column
    criteria: tuple[Column, ...]


def trust(priority: str = "source_priority", default: int = 99) -> Column:
    return F.coalesce(F.col(priority), F.lit(default)).cast("long")


def undated_oldest(date: str = "updated_at") -> Column:
    """The later the better, null last."""
    return -F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), F.lit(-(2**62)))


def longest(name: str) -> Column:
    return -F.char_length(trimmed(F.col(name))).cast("long")


def group_key(name: str) -> Column:
    return F.lower(trimmed(F.col(name)))


def survivors(records: DataFrame, key: str, rules: dict[str, Rule], record_id: str = "record_id", least: int = 2) -> DataFrame:
    """One row per group and field: the key, field_name, the record that gives the value, value as text, n_records."""
    best = []
    for name, rule in rules.items():
        order = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(rule.criteria)], F.col(record_id).alias("id"), F.col(name).cast("string").alias("value"))
        best.append(F.min(F.when(rule.usable, order)).alias(f"best_{name}"))
    keyed = records.withColumn("_key", group_key(key)).where(F.col("_key").isNotNull())
    groups = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n_records"), *best).where(F.col("n_records") >= least)
    picked = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(f"best_{n}.id").alias(record_id), F.col(f"best_{n}.value").alias("value")) for n in rules])
    return groups.select(F.col("_key").alias(key), "n_records", F.inline(picked)).where(F.col(record_id).isNotNull())


def golden(records: DataFrame, key: str, rules: dict[str, Rule], record_id: str = "record_id", least: int = 2) -> DataFrame:
    """One built record per group: the key, n_records and the surviving value of each field (text)."""
    long = survivors(records, key, rules, record_id, least)
    return long.groupBy(key).agg(F.max("n_records").alias("n_records"), *[F.max(F.when(F.col("field_name") == n, F.col("value"))).alias(n) for n in rules])


def entity_rules() -> dict[str, Rule]:
    """The rules for entity_record."""
    by_trust = (trust(), undated_oldest())
    return {
        "name": Rule(usable_text("name"), by_trust),
        "weight": Rule(usable_weight("weight"), by_trust),
        "effect": Rule(usable_text("effect"), by_trust),
        "obtained_from": Rule(usable_text("obtained_from"), (undated_oldest(), trust())),
        "description": Rule(usable_text("description"), (longest("description"), *by_trust)),
    }


def _value_times(records: DataFrame, key: str, field: str, usable: Column, date: str) -> DataFrame:
    """Distinct usable values of each group with their last date (null if never dated); bounded by distinct values, not rows."""
    keyed = records.where(usable).select(group_key(key).alias("_key"), trimmed(F.col(field)).alias("value"), F.col(date).alias("at"))
    return keyed.where(F.col("_key").isNotNull()).groupBy("_key", "value").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))


def learn_transitions(records: DataFrame, key: str, field: str, usable: Column, date: str = "updated_at") -> DataFrame:
    """Precedence among values, from dated rows: earlier, later, net (times later followed, less times it preceded), over 0 only."""
    dated = _value_times(records, key, field, usable, date).where(F.col("at").isNotNull())
    w = Window.partitionBy("_key").orderBy("at", "value")
    steps = dated.select("value", F.lead("value").over(w).alias("next")).where(F.col("next").isNotNull())
    pairs = steps.select(F.least("value", "next").alias("a"), F.greatest("value", "next").alias("b"), F.when(F.col("value") < F.col("next"), 1).otherwise(-1).alias("way"))
    net = pairs.groupBy("a", "b").agg(F.sum("way").alias("net"))
    forth = net.where("net > 0").select(F.col("a").alias("earlier"), F.col("b").alias("later"), "net")
    back = net.where("net < 0").select(F.col("b").alias("earlier"), F.col("a").alias("later"), (-F.col("net")).alias("net"))
    return forth.unionByName(back)


def currency_latest(records: DataFrame, key: str, field: str, usable: Column, date: str = "updated_at") -> DataFrame:
    """Current value of a field in each group: key, value, reason (dated, learned, undated).

    The learned pairs among a group's values are its partial order; an undated value that a chain of them leads to from the
    latest dated one, or any value where none is dated, may be the current one. Of these the ones that no other of them
    follows are the maximal ones (values that lead to each other count as one place); the commonest, then smallest, is taken.
    ``dated``: the latest dated value; ``learned``: precedence decided; ``undated``: no value has a date and none precedes another.
    """
    values = _value_times(records, key, field, usable, date)
    order = learn_transitions(records, key, field, usable, date)
    # values of a group are met by the distinct ones only, and only where a pair was learned
    known = values.select("_key", "value").join(order.select(F.col("earlier").alias("value"), "later"), "value")
    pairs = known.join(values.select("_key", F.col("value").alias("later")), ["_key", "later"]).groupBy("_key").agg(F.collect_list(F.struct(F.col("value").alias("a"), F.col("later").alias("b"))).alias("pairs"))
    groups = values.groupBy("_key").agg(
        F.max(F.when(F.col("at").isNotNull(), F.struct("at", "value"))).alias("latest"),
        F.collect_list(F.when(F.col("at").isNull(), F.struct("n", "value"))).alias("undated"),
    )

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [_maximal(*r) for r in zip(f["latest"], f["undated"], f["pairs"], strict=True)]
            yield pd.DataFrame({"_key": f["_key"], "value": [v for v, _ in out], "reason": [r for _, r in out]})

    shown = groups.join(pairs, "_key", "left").select("_key", F.col("latest.value").alias("latest"), "undated", "pairs")
    return shown.mapInPandas(decide, "_key string, value string, reason string").withColumnRenamed("_key", key)


def _maximal(latest: str | None, undated: list, pairs: list | None) -> tuple[str, str]:
    """The current value of one group, and the reason."""
    count = {x["value"]: x["n"] for x in undated}
    after: dict[str, set[str]] = {}
    for p in pairs if pairs is not None else []:
        # dated values are no later than the latest one, whatever was learned elsewhere
        if p["b"] in count:
            after.setdefault(p["a"], set()).add(p["b"])

    def reach(start: str) -> set[str]:
        met, left = set(), [start]
        while left:
            for b in after.get(left.pop(), ()):
                if b not in met:
                    met.add(b)
                    left.append(b)
        return met

    from_latest = reach(latest) if latest is not None else set()
    may = [v for v in count if latest is None or v in from_latest]
    if not may:
        return latest, "dated"
    reached = {v: reach(v) for v in may}
    # nothing stands after a maximal value that doesn't lead back to it
    best = [v for v in may if all(v in reached[b] for b in reached[v] if b in reached)]
    value = min(best, key=lambda v: (-count[v], v))
    return value, "learned" if latest is not None or any(reached.values()) else "undated"
