"""Loaders of domain records: a source table to canonical columns, one select per domain, with the priority of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators.reconcile import PRIORITY

DOMAINS = ("weapons", "armor", "items", "bosses", "spells")

# Names a field goes by in source tables, best first.
NAMES = {
    "name": ("name", "item_name", "title", "boss_name", "npc_name"),
    "source_id": ("id", "weapon_id", "armor_id", "item_id", "boss_id", "spell_id", "source_id"),
    "description": ("description", "desc", "lore", "flavor"),
    "category": ("category", "type", "weapon_type", "armor_type"),
    "weight": ("weight", "wgt"),
    "attack": ("attack", "attackPower", "attack_power", "damage"),
    "requirements": ("requiredAttributes", "required_attributes", "requirements", "requires"),
    "scaling": ("scalesWith", "scales_with", "scaling"),
    "negation": ("dmgNegation", "dmg_negation", "damage negation", "damage_negation"),
    "resistance": ("resistance", "resistances"),
    "dlc": ("dlc", "is_dlc", "DLC", "isDlc"),
    "effect": ("effect", "special_effect", "effects"),
    "obtained_from": ("obtainedFrom", "obtained_from", "location"),
    "sell_price": ("sellPrice", "sell_price", "price"),
    "max_stack": ("maxAmount", "max_amount", "max_stack"),
    "rarity": ("rarity",),
    "region": ("region",),
    "health_points": ("healthPoints", "health_points", "HP", "hp"),
    "drops": ("drops",),
    "cost": ("cost", "fp_cost"),
    "slots": ("slots",),
    "spell_type": ("type", "spell_type", "category"),
}


def field(df: DataFrame, want: str) -> Column:
    """The first filled of the columns a field may stand in, as text; null if there is none."""
    have = [F.col(f"`{c}`") for c in NAMES[want] if c in df.columns]
    texts = [c.cast("string") if not str(dict(df.dtypes).get(n, "")).startswith(("array", "struct", "map")) else F.to_json(c) for n, c in zip([c for c in NAMES[want] if c in df.columns], have)]
    return V.first_filled(*texts) if texts else F.lit(None).cast("string")


def common(df: DataFrame, source: str, kind: str) -> list[Column]:
    """Columns all domains share."""
    edition = F.lit(True) if kind == "dlc" else F.coalesce(V.flag(field(df, "dlc")), F.lit(False))
    return [
        field(df, "source_id").alias("source_id"), field(df, "name").alias("name"), T.slug(field(df, "name")).alias("canonical_slug"),
        V.missing_as_null(field(df, "description")).alias("description"), edition.alias("is_dlc"), F.lit(source).alias("source"), F.lit(PRIORITY[kind]).alias("source_priority"),
    ]


def load(df: DataFrame, domain: str, source: str, kind: str) -> DataFrame:
    """Canonical records of a source table of one domain; rows without a name are dropped. kind: dlc, base, api or fmg."""
    if domain not in DOMAINS:
        raise ValueError(f"unknown domain: {domain}")
    own: list[Column] = []
    weight = V.safe_float(field(df, "weight")).alias("weight")
    # read once, as each of their columns looks into the whole list
    lists = {"weapons": ("attack", "requirements", "scaling"), "armor": ("negation", "resistance"), "spells": ("requirements",)}.get(domain, ())
    df = df.withColumns({f"_{f}": V.entries(field(df, f)) for f in lists}) if lists else df
    entries = lambda f: F.col(f"_{f}")
    if domain == "weapons":
        parts = V.damage(entries("attack")) | V.requirements(entries("requirements")) | V.scaling(entries("scaling"))
        own = [V.weapon_type(field(df, "category")).alias("weapon_type"), weight, *[c.alias(n) for n, c in parts.items()]]
    elif domain == "armor":
        parts = V.negations(entries("negation")) | V.resistances(entries("resistance"))
        own = [V.armor_type(field(df, "category")).alias("armor_type"), weight, *[c.alias(n) for n, c in parts.items()]]
    elif domain == "items":
        numbers = [V.safe_int(field(df, n)).alias(n) for n in ("sell_price", "max_stack")]
        own = [V.item_category(field(df, "category")).alias("category"), weight, *numbers, V.rarity(field(df, "rarity")).alias("rarity"), field(df, "effect").alias("effect"), V.structured_text(field(df, "obtained_from")).alias("obtained_from")]
    elif domain == "bosses":
        own = [field(df, "region").alias("region"), field(df, "obtained_from").alias("location"), V.safe_int(field(df, "health_points")).alias("health_points"), V.structured_text(field(df, "drops")).alias("drops")]
    else:
        needs = {n: c for n, c in V.requirements(entries("requirements")).items() if n in ("required_int", "required_fai", "required_arc")}
        kind_of = F.lower(field(df, "spell_type"))
        own = [F.when(kind_of.contains("incant"), "incantation").when(kind_of.contains("sorc"), "sorcery").otherwise("other").alias("spell_type"), V.safe_int(field(df, "cost")).alias("fp_cost"), V.safe_int(field(df, "slots")).alias("slots_required"), field(df, "effect").alias("effect"), *[c.alias(n) for n, c in needs.items()]]
    return df.select(*common(df, source, kind), *own).where(F.col("name").isNotNull())


def entity_description(df: DataFrame, columns: list[str]) -> Column:
    """Description of an entity: the filled ones of the columns that are there, as paragraphs."""
    return V.merged_text(*[c for c in columns if c in df.columns])


def stats_description(description: str, stats: str, location: str) -> Column:
    """Description with a list of stats (a map) and the place: "text\\n\\nStats: k: v, k: v\\n\\nLocation: place"."""
    pairs = F.array_join(F.transform(F.map_entries(F.col(stats)), lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string"))), ", ")
    return F.concat_ws("\n\n", F.nullif(F.trim(description), F.lit("")), F.when(pairs != "", F.concat(F.lit("Stats: "), pairs)), F.when(F.trim(location) != "", F.concat(F.lit("Location: "), F.trim(location))))


def meta_map(df: DataFrame, leave: list[str]) -> Column:
    """The other columns of a row as a map of texts, nulls left out."""
    pairs = F.create_map(*[x for c in df.columns if c not in leave for x in (F.lit(c), F.col(c).cast("string"))])
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Columns in a fixed order (missing ones as null), then the others."""
    first = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in order]
    return df.select(*first, *[c for c in df.columns if c not in order])
