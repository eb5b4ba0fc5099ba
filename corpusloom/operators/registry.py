"""Versioned schemas of the canonical tables: shapes, coercion and rules, and which version a dataset name means."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import ARMOR_SLOTS, NEGATIONS, RARITIES, RESISTANCES, WEAPON_TYPES
from . import profile


@dataclass(frozen=True)
class Field:
    """A column: its type, whether it must be there, and what its values may be."""

    type: str
    required: bool = False
    unique: bool = False
    values: tuple[str, ...] = ()
    least: float | None = None


@dataclass(frozen=True)
class Schema:
    """A version of a dataset's schema. Columns beyond it are allowed unless ``strict``."""

    dataset: str
    version: str
    fields: dict[str, Field]
    notes: str = ""
    deprecated: bool = False
    strict: bool = False
    compatible: tuple[str, ...] = field(default=())

    @property
    def tag(self) -> str:
        return f"{self.dataset}_{self.version}"


def _named(key: str, **more: Field) -> dict[str, Field]:
    return {key: Field("bigint", True, True), "name": Field("string", True), **more}


def _counts(names: list[str], kind: str = "bigint") -> dict[str, Field]:
    return {n: Field(kind, least=0) for n in dict.fromkeys(names)}


# Categories of items.
ITEM_KINDS = ("weapon", "armor", "consumable", "key_item", "spell", "ash_of_war", "talisman", "tool", "material", "spirit", "other")

REGISTRY: dict[str, list[Schema]] = {
    s.dataset: [s]
    for s in (
        Schema("items", "v1", _named("item_id", category=Field("string", True, values=ITEM_KINDS), description=Field("string"), weight=Field("double", least=0), rarity=Field("string", values=RARITIES), **_counts(["sell_price", "max_stack"]))),
        Schema("weapons", "v1", _named("weapon_id", weapon_type=Field("string", True, values=tuple(dict.fromkeys(WEAPON_TYPES.values()))), **_counts(["weight"], "double"))),
        Schema("bosses", "v1", _named("boss_id", health_points=Field("bigint", least=0), region=Field("string"))),
        Schema("armor", "v1", _named("armor_id", armor_type=Field("string", True, values=tuple(s for s, _ in ARMOR_SLOTS)), **_counts(["weight", *NEGATIONS.values()], "double"), **_counts(list(RESISTANCES.values())))),
        Schema("spells", "v1", _named("spell_id", spell_type=Field("string", True, values=("sorcery", "incantation")), description=Field("string"), **_counts(["fp_cost", "stamina_cost", "slots_required", "required_int", "required_fai", "required_arc"]))),
    )
}


def find(name: str, registry: dict[str, list[Schema]] | None = None, deprecated: bool = False) -> Schema | None:
    """Schema of a dataset name: ``weapons`` is its latest version, ``weapons_v1`` that one; None if there is none."""
    registry = registry or REGISTRY
    plain = re.sub(r"[^a-z0-9_.]+", "_", name.strip().lower())
    m = re.match(r"^(.+)_(v[a-z0-9][a-z0-9_.]*)$", plain)
    dataset, version = (m.group(1), m.group(2)) if m and m.group(1) in registry else (plain, None)
    live = [s for s in registry.get(dataset, []) if deprecated or not s.deprecated]
    if version is not None:
        return next((s for s in live if s.version == version), None)
    return live[-1] if live else None


def checks(schema: Schema) -> list[profile.Check]:
    """The rules of a schema as checks."""
    out = []
    for name, f in schema.fields.items():
        if f.required:
            out.append(profile.not_null(name))
        if f.required and f.type == "string":
            out.append(profile.non_empty(name))
        if f.values:
            out.append(profile.one_of(name, list(f.values)))
        if f.least is not None:
            out.append(profile.at_least(name, f.least))
    return out


def validate(df: DataFrame, schema: Schema) -> tuple[DataFrame, DataFrame]:
    """(coerced rows, violations). Missing columns: required ones are violations of their own, others come as null."""
    absent = [n for n in schema.fields if n not in df.columns]
    full = df.withColumns({n: F.lit(None).cast(schema.fields[n].type) for n in absent}) if absent else df
    coerced = profile.coerced(full, {n: f.type for n, f in schema.fields.items()})
    found = profile.violations(coerced, checks(schema), [n for n, f in schema.fields.items() if f.unique])
    spark = df.sparkSession
    extra = [("missing_column", n, 1) for n in absent if schema.fields[n].required]
    extra += [("unknown_column", n, 1) for n in df.columns if n not in schema.fields and schema.strict]
    more = spark.createDataFrame(extra, "rule string, column_name string, violations long")
    return coerced, found.unionByName(more).where("violations > 0")
