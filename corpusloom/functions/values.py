"""Value functions as Column expressions: safe numbers, loosely written structures, domain vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of damage kinds in source data and the columns they go to.
DAMAGE = {
    "phy": "damage_physical", "mag": "damage_magic", "fire": "damage_fire", "ligt": "damage_lightning", "lit": "damage_lightning",
    "lightning": "damage_lightning", "holy": "damage_holy", "crit": "damage_critical",
}

# Names of attributes and the requirement columns they go to.
REQUIREMENTS = {
    "str": "required_str", "strength": "required_str", "dex": "required_dex", "dexterity": "required_dex", "int": "required_int",
    "intelligence": "required_int", "fai": "required_fai", "faith": "required_fai", "arc": "required_arc", "arcane": "required_arc",
}

# Names of attributes and the scaling columns they go to.
SCALING = {"str": "scaling_str", "dex": "scaling_dex", "int": "scaling_int", "fai": "scaling_fai", "arc": "scaling_arc"}

# Names of armor negations and the columns they go to.
NEGATIONS = {
    "phy": "defense_physical", "physical": "defense_physical", "strike": "defense_strike", "vs str.": "defense_strike", "slash": "defense_slash",
    "vs sla.": "defense_slash", "pierce": "defense_pierce", "vs pie.": "defense_pierce", "mag": "defense_magic", "magic": "defense_magic",
    "fir": "defense_fire", "fire": "defense_fire", "lit": "defense_lightning", "ligt": "defense_lightning", "lightning": "defense_lightning",
    "hol": "defense_holy", "holy": "defense_holy",
}

# Names of armor resistances and the columns they go to.
RESISTANCES = {
    "imm.": "resistance_immunity", "immunity": "resistance_immunity", "rob.": "resistance_robustness", "robustness": "resistance_robustness",
    "foc.": "resistance_focus", "focus": "resistance_focus", "vit.": "resistance_vitality", "vitality": "resistance_vitality", "poi.": "poise", "poise": "poise",
}

# Weapon categories and the types they belong to.
WEAPON_TYPES = {
    "straight sword": "sword", "curved sword": "sword", "thrusting sword": "sword", "sword": "sword", "greatsword": "greatsword",
    "great sword": "greatsword", "colossal sword": "colossal_sword", "colossal weapon": "colossal_sword", "dagger": "dagger", "twinblade": "spear",
    "spear": "spear", "great spear": "spear", "halberd": "halberd", "axe": "axe", "great axe": "axe", "hammer": "hammer", "great hammer": "hammer",
    "flail": "flail", "bow": "bow", "crossbow": "crossbow", "staff": "staff", "glintstone staff": "staff", "seal": "seal", "sacred seal": "seal",
    "fist": "fist", "claw": "claw", "whip": "whip", "torch": "other", "shield": "other", "thrusting shield": "other", "thrusting shields": "other",
    "ballista": "other", "other": "other",
}

# Item categories as written and as named; in the order in which parts of them are looked for.
ITEM_CATEGORIES = {
    "weapon": "weapon", "armor": "armor", "helm": "armor", "chest armor": "armor", "gauntlets": "armor", "leg armor": "armor",
    "consumable": "consumable", "reusable": "tool", "tool": "tool", "cookbook": "tool", "crafting": "tool", "talisman": "talisman",
    "ash of war": "ash_of_war", "ashes of war": "ash_of_war", "key item": "key_item", "keyitem": "key_item", "bell bearing": "key_item",
    "bell": "key_item", "great rune": "key_item", "remembrance": "key_item", "material": "material", "upgrade material": "material",
    "crystal tear": "tool", "ammo": "tool", "cookbooks": "tool", "multi": "other", "whetblade": "tool", "sorcery": "spell",
    "incantation": "spell", "spell": "spell",
}

# Rarities, and parts of armor categories with the slot they mean, the first that occurs deciding.
RARITIES = ("common", "uncommon", "rare", "legendary")
ARMOR_SLOTS = (("head", ("helm", "head")), ("arms", ("gauntlet", "glove", "arm")), ("legs", ("leg", "greave", "boot")), ("chest", ("chest", "armor", "robe", "body")))

ENTRY = "array<struct<name:string,amount:string,scaling:string,value:string>>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def safe_float(text: Column | str) -> Column:
    """Number of a text with thousands commas; null if it is none."""
    return F.replace(F.trim(_c(text).cast("string")), F.lit(","), F.lit("")).try_cast("double")


def safe_int(text: Column | str) -> Column:
    """Whole number, truncated toward zero; null if it is none or not finite."""
    x = safe_float(text)
    return F.when(F.abs(x) < 9.2e18, F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("long"))


def flag(text: Column | str) -> Column:
    """Truth value of 1, true, yes, y, t or their opposites; null else."""
    t = F.lower(F.trim(_c(text).cast("string")))
    return F.when(t.isin("1", "true", "yes", "y", "t", "1.0"), True).when(t.isin("0", "false", "no", "n", "f", "", "0.0"), False)


def missing_as_null(text: Column | str) -> Column:
    """Null for blank text and the words nan, none, null."""
    c = _c(text)
    return F.when(F.lower(F.trim(c)).isin("", "nan", "none", "null"), None).otherwise(c)


def first_filled(*columns: Column | str) -> Column:
    """First column that isn't null or blank, trimmed."""
    return F.coalesce(*[F.when(F.trim(_c(c)) != "", F.trim(_c(c))) for c in columns])


def merged_text(*columns: Column | str, sep: str = "\n\n") -> Column:
    """Filled columns joined, missing words left out."""
    return F.concat_ws(sep, *[F.trim(missing_as_null(c)) for c in columns])


def labelled_text(columns: dict[str, str], sep: str = "\n\n") -> Column:
    """Filled columns joined as "Label: value" lines; a single one stands without its label."""
    filled = {c: F.trim(missing_as_null(c)) for c in columns}
    n = sum((f.isNotNull().cast("int") for f in filled.values()), F.lit(0))
    with_labels = F.concat_ws(sep, *[F.concat(F.lit(f"{label}: "), filled[c]) for c, label in columns.items()])
    return F.when(n > 1, with_labels).otherwise(F.coalesce(*filled.values(), F.lit("")))


def structured_json(text: Column | str) -> Column:
    """JSON text of a value written as JSON or as a Python literal (single quotes, None, True, False); null if neither."""
    t = F.trim(_c(text))
    strict = F.when(F.try_parse_json(t).isNotNull(), t)
    python = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    swapped = F.regexp_replace(F.regexp_replace(python, r'(?<!\\)"', '\\\\\\\\"'), "(?<!\\\\)'", '"')
    loose = F.when(F.try_parse_json(swapped).isNotNull(), swapped)
    return F.coalesce(strict, loose)


def entries(text: Column | str) -> Column:
    """Entries of a list of objects, or of an object of name: amount, in loosely written text; empty if neither.

    An object in a list is an entry if it has a name, else each of its keys is one.
    """
    doc = structured_json(text)
    pair = lambda e: F.named_struct(F.lit("name"), e["key"], F.lit("amount"), e["value"], F.lit("scaling"), e["value"], F.lit("value"), e["value"])
    pairs = lambda m: F.transform(F.map_entries(m), pair)
    named = lambda m: F.array(F.named_struct(*[x for k in ("name", "amount", "scaling", "value") for x in (F.lit(k), F.try_element_at(m, F.lit(k)))]))
    objects = F.filter(F.from_json(doc, "array<map<string,string>>"), lambda m: m.isNotNull())
    listed = F.flatten(F.transform(objects, lambda m: F.when(F.map_contains_key(m, "name"), named(m)).otherwise(pairs(m))))
    return F.when(doc.startswith("["), listed).when(doc.startswith("{"), pairs(F.from_json(doc, "map<string,string>"))).otherwise(F.array().cast(ENTRY))


def _pivot(found: Column, names: dict[str, str], value: str) -> dict[str, Column]:
    """Of each target column, the value of the last entry named for it."""

    def last(target: str) -> Column:
        keys = [k for k, t in names.items() if t == target]
        hits = F.filter(found, lambda e: F.lower(F.trim(e["name"])).isin(*keys))
        return F.try_element_at(hits, F.lit(-1))[value]

    return {target: last(target) for target in dict.fromkeys(names.values())}


def damage(found: Column | str) -> dict[str, Column]:
    """Damage columns of attack entries; null where not given."""
    return {t: safe_float(v) for t, v in _pivot(_c(found), DAMAGE, "amount").items()}


def requirements(found: Column | str) -> dict[str, Column]:
    """Requirement columns of attribute entries."""
    amounts, others = _pivot(_c(found), REQUIREMENTS, "amount"), _pivot(_c(found), REQUIREMENTS, "value")
    return {t: safe_int(F.coalesce(amounts[t], others[t])) for t in amounts}


def scaling(found: Column | str) -> dict[str, Column]:
    """Scaling grades of entries, "-" where not given."""
    given = F.filter(_c(found), lambda e: e["scaling"].isNotNull())
    return {t: F.coalesce(F.nullif(F.upper(F.trim(v)), F.lit("")), F.lit("-")) for t, v in _pivot(given, SCALING, "scaling").items()}


def _not_below(number: Column) -> Column:
    return F.when(number.isNotNull(), F.greatest(number, F.lit(0).cast("double")))


def negations(found: Column | str) -> dict[str, Column]:
    """Armor defense columns, not below 0; null where not given."""
    return {t: _not_below(safe_float(v)) for t, v in _pivot(_c(found), NEGATIONS, "amount").items()}


def resistances(found: Column | str) -> dict[str, Column]:
    """Armor resistance columns, not below 0, whole but for poise; null where not given."""
    return {t: _not_below(safe_float(v)) if t == "poise" else _not_below(safe_int(v)).cast("long") for t, v in _pivot(_c(found), RESISTANCES, "amount").items()}


def weapon_type(text: Column | str) -> Column:
    """Type of a weapon category, singular or plural; other if unknown."""
    t = F.trim(F.translate(F.lower(_c(text)), "-_/", "   "))
    known = _map(WEAPON_TYPES)
    one = F.when(t.endswith("s"), F.try_element_at(known, F.substring(t, F.lit(1), F.length(t) - 1)))
    return F.coalesce(one, F.try_element_at(known, t), F.try_element_at(known, F.regexp_replace(t, "s+$", "")), F.lit("other"))


def armor_type(text: Column | str, chest_first: bool = False) -> Column:
    """Slot of an armor category by the parts it holds; ``chest_first`` keeps "chest armor" from meaning arms."""
    t = F.lower(F.trim(_c(text)))
    slots = sorted(ARMOR_SLOTS, key=lambda s: s[0] not in ("chest", "legs")) if chest_first else ARMOR_SLOTS
    out = F
    for slot, parts in slots:
        hit = F.coalesce(t.rlike("|".join(parts)), F.lit(False))
        out = out.when(hit, slot)
    return out.otherwise("other")


def item_category(text: Column | str) -> Column:
    """Named category: as listed, else of the first listed one that is part of it or it of; other if none."""
    t = F.trim(F.regexp_replace(F.translate(F.lower(_c(text)), "-_", "  "), r"\s+", " "))
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in ITEM_CATEGORIES.items()])
    part = F.try_element_at(F.filter(listed, lambda e: F.contains(t, e["k"]) | F.contains(e["k"], t)), F.lit(1))["v"]
    return F.coalesce(F.when(t != "", F.coalesce(F.try_element_at(_map(ITEM_CATEGORIES), t), part)), F.lit("other"))


def rarity(text: Column | str) -> Column:
    """Listed rarity, or null."""
    t = F.lower(F.trim(_c(text)))
    return F.when(t.isin(*RARITIES), t)


def categorical(text: Column | str, names: dict[str, str]) -> Column:
    """Lower, trimmed value, replaced where ``names`` lists it; null as the word nan."""
    t = F.coalesce(F.lower(F.trim(_c(text).cast("string"))), F.lit("nan"))
    return F.coalesce(F.try_element_at(_map(names), t), t) if names else t


def structured_text(text: Column | str) -> Column:
    """Readable line of entries or of an object: "name: amount; name: amount"."""
    doc = structured_json(text)
    shown = lambda n, v: F.when(v.isNull() | (v == ""), n).otherwise(F.concat(n, F.lit(": "), v))
    as_list = F.filter(F.from_json(doc, ENTRY), lambda e: e["name"].isNotNull())
    from_list = F.array_join(F.transform(as_list, lambda e: shown(e["name"], F.coalesce(e["amount"], e["scaling"], e["value"]))), "; ")
    from_map = F.array_join(F.transform(F.map_entries(F.from_json(doc, "map<string,string>")), lambda e: shown(e["key"], e["value"])), "; ")
    return F.when(doc.startswith("["), from_list).when(doc.startswith("{"), from_map).otherwise(F.trim(_c(text)))


def entity_type_of(table_name: Column | str) -> Column:
    """Entity type of a table name: singular by a table of irregular forms, else without the last s."""
    # Plurals that don't just add an s.
    irregular = {"bosses": "boss", "classes": "class", "sorceries": "sorcery", "ashes": "ash_of_war", "npcs": "npc", "armors": "armor", "incantations": "incantation"}
    t = F.lower(F.trim(_c(table_name)))
    return F.coalesce(F.try_element_at(_map(irregular), t), F.regexp_replace(t, "s$", ""))


def iso_time(text: Column | str) -> Column:
    """Time of an ISO text; Z is UTC, no zone is UTC, a date is its midnight; null if it is none."""
    return F.try_to_timestamp(F.replace(F.trim(_c(text)), F.lit("Z"), F.lit("+00:00")))


def repaired_json(text: Column | str) -> Column:
    """The object in a longer answer: from the first brace to the last; null if that isn't JSON."""
    inner = F.regexp_extract(_c(text), r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(inner).isNotNull(), inner)
