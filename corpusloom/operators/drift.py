"""Schemas that drift between files: one consistent table, and each change by file.

Every record is one JSON object. The schema of a file (its "header") is gathered from all its
records in parallel: for each top-level field, how many non-null values have which JSON type.
Headers are a few numbers per (file, field), made by a map-side combined aggregate; all later
steps (ordering the files of a feed, comparing neighbours, folding types through the promotion
lattice) work on headers only. The values are read a second time for renames alone, and only
those of fields that vanished or appeared.

Defined cases
-------------
* null, blank or broken payloads, payloads with a key twice, and payloads that aren't objects, have no fields
* a file without usable records has no fields: all fields of its predecessor are ``removed``
* a field that is only ever null in a file isn't in it
* types tied in a file: the first of string, number, boolean, array, object is taken
* ``exported_at`` null: the file comes before the dated files of its feed
* repeated records count as often as they stand; for renames one value per item is compared
* feeds without a name (null) form one feed; extra columns are ignored
* empty tables give empty results
"""

from __future__ import annotations

import ast
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import checkpointed

#: JSON types in the order that breaks ties.
TYPES = ("string", "number", "boolean", "array", "object")

#: The promotion lattice: the least type that holds both. Any pair not listed promotes to string.
PROMOTE = {("boolean", "number"): "number", ("array", "object"): "array"}

#: Spark types of the lattice's types in the unified table; nested values stay JSON text.
SQL_TYPES = {"string": "string", "number": "double", "boolean": "boolean", "array": "string", "object": "string"}


def promote(a: str | None, b: str | None) -> str | None:
    """Join of two types in the lattice; None is its bottom."""
    if a is None or b is None or a == b:
        return a or b
    return PROMOTE.get(tuple(sorted((a, b))), "string")


def explode_fields(records: DataFrame, payload: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """One row per top-level field with a non-null value: ``keep`` columns, field_name, value (variant), json_type."""
    keep = keep or ["file_id"]
    parsed = records.select(*keep, F.try_parse_json(F.col(payload)).alias("_doc")).where(
        F.col("_doc").isNotNull() & F.schema_of_variant("_doc").startswith("OBJECT")
    )
    spark = records.sparkSession
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer()))
    return fields.select(*keep, F.col("key").alias("field_name"), "value", json_type(F.col("value")).alias("json_type")).where(
        F.col("json_type").isNotNull()
    )


def json_type(value: Column) -> Column:
    """JSON type of a variant; null for JSON null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind == "VOID", None)
        .when(kind.isNotNull(), "number")
    )


def headers(records: DataFrame, payload: str = "payload") -> DataFrame:
    """Schema of each file: file_id, field_name, json_type (that of most values), n_values, types (all that occur)."""
    fields = explode_fields(records, payload)
    counts = fields.groupBy("file_id", "field_name").agg(
        *[F.count_if(F.col("json_type") == t).alias(t) for t in TYPES], F.count(F.lit(1)).alias("n_values")
    )
    ranked = F.greatest(*[F.struct(F.col(t).alias("n"), F.lit(-i).alias("o"), F.lit(t).alias("t")) for i, t in enumerate(TYPES)])
    return counts.select(
        "file_id",
        "field_name",
        ranked["t"].alias("json_type"),
        "n_values",
        F.filter(F.array(*[F.when(F.col(t) > 0, t) for t in TYPES]), lambda x: x.isNotNull()).alias("types"),
    )


def file_order(files: DataFrame) -> DataFrame:
    """Each file with the one before it in its feed: feed_id, file_id, prev_id (null for the first)."""
    w = Window.partitionBy("feed_id").orderBy(F.col("exported_at").asc_nulls_first(), "file_id")
    return files.select("feed_id", "file_id", F.lag("file_id").over(w).alias("prev_id"))


def _plain(value: object) -> str:
    """A form in which a value is equal however it is written: typed, as text, as JSON or Python literal, as list or object."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(float(value))
    if isinstance(value, (int, float)):
        return repr(float(value)) if math.isfinite(value) else str(value)
    if isinstance(value, str):
        text = value.strip()
        low = text.lower()
        if low in ("true", "yes"):
            return "1.0"
        if low in ("false", "no"):
            return "0.0"
        if text[:1] in "[{(" or text[:1].isdigit() or text[:1] in "+-.":
            for read in (json.loads, ast.literal_eval):
                try:
                    parsed = read(text)
                except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                    continue
                if not isinstance(parsed, str):
                    return _plain(parsed)
        return low
    if isinstance(value, (list, tuple)):
        return "|".join(sorted(_plain(x) for x in value))
    if isinstance(value, dict):
        if len(value) == 2 and "name" in value:
            other = next(v for k, v in value.items() if k != "name")
            return f"{_plain(value['name'])}={_plain(other)}"
        return "|".join(sorted(f"{k.strip().lower()}={_plain(v)}" for k, v in value.items()))
    return str(value)


@F.pandas_udf(StringType())
def plain_value(values: pd.Series) -> pd.Series:
    """Digest input for value comparison, from JSON text."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return _plain(json.loads(text))
        except ValueError:
            return text.lower()

    return values.map(one)


def renames(records: DataFrame, moved: DataFrame, item_key: str = "id", payload: str = "payload", agree: float = 0.5) -> DataFrame:
    """Fields that go on under another name: file_id, old_name, new_name.

    ``moved`` has file_id, prev_id and the arrays gone and come of field names. Two fields are the
    same property if the items that both files hold have equal values under the two names, in
    at least ``agree`` of the cases; each name takes part in one rename only, of the best agreement.
    Only the values of gone and come fields are compared, keyed by (file, item), so that a large
    feed spreads over all tasks.
    """
    both = moved.where((F.size("gone") > 0) & (F.size("come") > 0))
    old = both.select("file_id", F.col("prev_id").alias("at"), F.lit(True).alias("old"), F.col("gone").alias("names"))
    new = both.select("file_id", F.col("file_id").alias("at"), F.lit(False).alias("old"), F.col("come").alias("names"))
    # a file is compared as the later and as the earlier one of two pairs at most
    wanted = old.unionByName(new).groupBy("at").agg(F.collect_list(F.struct("file_id", "old", "names")).alias("wanted"))
    item = F.try_variant_get(F.try_parse_json(F.col(payload)), f"$.{item_key}", "string").alias("item")
    # records meet the few names wanted of their file before they are taken apart, so only those values move
    held = records.select(F.col("file_id").alias("at"), payload, item).where(F.col("item").isNotNull()).join(wanted, "at")
    values = explode_fields(held, payload, ["item", "wanted"]).select("item", "field_name", "value", F.inline("wanted"))
    seen = (
        values.where(F.array_contains("names", F.col("field_name")))
        .select("file_id", "item", "old", "field_name", F.to_json("value").alias("json"))
        .groupBy("file_id", "item", "old", "field_name")
        .agg(F.min("json").alias("json"))
        .withColumn("v", F.xxhash64(plain_value("json")))
    )
    left = seen.where("old").select("file_id", "item", F.col("field_name").alias("old_name"), F.col("v").alias("v1"))
    right = seen.where("NOT old").select("file_id", "item", F.col("field_name").alias("new_name"), F.col("v").alias("v2"))
    scored = (
        left.join(right, ["file_id", "item"])
        .groupBy("file_id", "old_name", "new_name")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v1") == F.col("v2")).alias("same"))
        .withColumn("agreement", F.col("same") / F.col("n"))
        .where(F.col("agreement") >= agree)
    )
    bare = lambda c: F.regexp_replace(F.lower(F.col(c)), "[^a-z0-9]", "")
    rank = F.struct(-F.col("agreement"), -F.col("same"), F.levenshtein(bare("old_name"), bare("new_name")), "old_name", "new_name")
    best = lambda side: F.row_number().over(Window.partitionBy("file_id", side).orderBy(rank))
    return scored.select("file_id", "old_name", "new_name", best("old_name").alias("a"), best("new_name").alias("b")).where("a = 1 AND b = 1").select(
        "file_id", "old_name", "new_name"
    )


def _compared(files: DataFrame, heads: DataFrame) -> DataFrame:
    """file_id, prev_id, and the header maps now and before ({field: type}); files without predecessor left out."""
    maps = heads.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "json_type"))).alias("fields"))
    none = F.create_map().cast("map<string,string>")
    order = file_order(files).where(F.col("prev_id").isNotNull())
    return (
        order.join(maps.withColumnRenamed("fields", "now"), "file_id", "left")
        .join(maps.select(F.col("file_id").alias("prev_id"), F.col("fields").alias("before")), "prev_id", "left")
        .select("feed_id", "file_id", "prev_id", F.coalesce("now", none).alias("now"), F.coalesce("before", none).alias("before"))
        .withColumn("gone", F.array_except(F.map_keys("before"), F.map_keys("now")))
        .withColumn("come", F.array_except(F.map_keys("now"), F.map_keys("before")))
    )


def changes(files: DataFrame, records: DataFrame, item_key: str = "id", payload: str = "payload") -> DataFrame:
    """Each difference between a file and the one before it in its feed.

    files: file_id, feed_id, exported_at; records: file_id and JSON text ``payload``.
    Returns feed_id, file_id, change_kind (added, removed, renamed, retyped), field_name, old_name,
    old_type, new_type. ``old_name`` is null unless renamed.
    """
    compared = _compared(files, headers(records, payload))
    renamed = renames(records, compared, item_key, payload)
    by_file = renamed.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("new_name", "old_name"))).alias("renamed"))
    full = compared.join(by_file, "file_id", "left").withColumn("renamed", F.coalesce("renamed", F.create_map().cast("map<string,string>")))

    def row(kind: str, name: Column, old: Column, was: Column, now: Column) -> Column:
        return F.struct(F.lit(kind).alias("change_kind"), name.alias("field_name"), old.alias("old_name"), was.alias("old_type"), now.alias("new_type"))

    nothing = F.lit(None).cast("string")
    before, now, ren = F.col("before"), F.col("now"), F.col("renamed")
    added = F.transform(F.array_except("come", F.map_keys(ren)), lambda n: row("added", n, nothing, nothing, now[n]))
    removed = F.transform(F.array_except("gone", F.map_values(ren)), lambda n: row("removed", n, nothing, before[n], nothing))
    moved = F.transform(F.map_keys(ren), lambda n: row("renamed", n, ren[n], before[ren[n]], now[n]))
    moved_type = F.filter(F.map_keys(ren), lambda n: before[ren[n]] != now[n])
    stayed_type = F.filter(F.array_intersect(F.map_keys(now), F.map_keys(before)), lambda n: before[n] != now[n])
    retyped = F.concat(
        F.transform(moved_type, lambda n: row("retyped", n, ren[n], before[ren[n]], now[n])),
        F.transform(stayed_type, lambda n: row("retyped", n, nothing, before[n], now[n])),
    )
    return full.select("feed_id", "file_id", F.inline(F.concat(added, removed, moved, retyped)))


def change_log(files: DataFrame, records: DataFrame, item_key: str = "id") -> DataFrame:
    """:func:`changes` numbered in the order of the files of each feed, then kind and name."""
    when = files.select("file_id", "exported_at")
    w = Window.partitionBy("feed_id").orderBy(F.col("exported_at").asc_nulls_first(), "file_id", "change_kind", "field_name")
    return changes(files, records, item_key).join(when, "file_id").withColumn("step", F.row_number().over(w))


def canonical_name(field_name: Column) -> Column:
    """Column name of a field: lower snake case, so that scalesWith, scales_with and "scales with" are one."""
    split = F.regexp_replace(field_name, "([a-z0-9])([A-Z])", "$1_$2")
    return F.regexp_replace(F.regexp_replace(F.lower(split), "[^\\p{L}\\p{N}]+", "_"), "^_+|_+$", "")


def field_names(files: DataFrame, records: DataFrame, item_key: str = "id", heads: DataFrame | None = None) -> DataFrame:
    """The column each field of each file goes to: file_id, field_name, column_name.

    Renames are followed within a feed: all names of a property lead to the one it had first. Each
    feed's renames (a few per file, not its records) are folded in file order by one task.
    """
    heads = headers(records) if heads is None else heads
    w = Window.partitionBy("feed_id").orderBy(F.col("exported_at").asc_nulls_first(), "file_id")
    steps = files.select("feed_id", "file_id", F.row_number().over(w).alias("step"))
    ren = renames(records, _compared(files, heads), item_key).groupBy("file_id").agg(F.collect_list(F.struct("old_name", "new_name")).alias("renamed"))
    names = heads.groupBy("file_id").agg(F.sort_array(F.collect_list("field_name")).alias("names"))
    rows = steps.join(names, "file_id", "left").join(ren, "file_id", "left")

    def follow(key: tuple, chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[str, str] = {}
        all_rows = pd.concat(list(chunks)).sort_values("step")
        out = []
        for r in all_rows.itertuples():
            links = [] if r.renamed is None else [(x["old_name"], x["new_name"]) for x in r.renamed]
            moved = {new: first.pop(old, old) for old, new in links}
            first.update(moved)
            out += [(r.file_id, n, first.get(n, n)) for n in ([] if r.names is None else r.names)]
        yield pd.DataFrame(out, columns=["file_id", "field_name", "property"])

    linked = rows.groupBy("feed_id").applyInPandas(follow, "file_id long, field_name string, property string")
    return linked.select("file_id", "field_name", canonical_name(F.col("property")).alias("column_name"))


def union_schema(heads: DataFrame, names: DataFrame, max_columns: int = 2000) -> dict[str, str]:
    """Column name to lattice type over all types that occur in any file; one small row per column reaches the driver.

    More than ``max_columns`` columns are refused: such data have keys for values and want the long form.
    """
    typed = heads.join(names, ["file_id", "field_name"]).select("column_name", F.explode("types").alias("t")).groupBy("column_name").agg(F.array_sort(F.collect_set("t")).alias("types"))
    rows = typed.limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} columns; use unified_long")
    schema = {}
    for r in sorted(rows):
        kind = None
        for t in r["types"]:
            kind = promote(kind, t)
        schema[r["column_name"]] = kind
    return schema


def unified_long(files: DataFrame, records: DataFrame, item_key: str = "id") -> DataFrame:
    """All records in one long table: record_id, file_id, field_name, column_name, json_type, value (text; nested values as JSON).

    Nothing is left out, of however many columns, also where two fields of a record lead to one column.
    """
    fields = explode_fields(records, keep=["record_id", "file_id"])
    named = fields.join(field_names(files, records, item_key), ["file_id", "field_name"])
    text = F.when(F.col("json_type") == "string", F.variant_get("value", "$", "string")).otherwise(F.to_json("value"))
    return named.select("record_id", "file_id", "field_name", "column_name", "json_type", text.alias("value"))


def displaced(files: DataFrame, records: DataFrame, item_key: str = "id") -> DataFrame:
    """The values that :func:`unified` has no place for, as another field of their record leads to the same column: rows of :func:`unified_long`."""
    w = Window.partitionBy("record_id", "file_id", "column_name").orderBy(F.desc("value"), F.desc("field_name"))
    return unified_long(files, records, item_key).withColumn("_n", F.row_number().over(w)).where("_n > 1").drop("_n")


def unified(files: DataFrame, records: DataFrame, item_key: str = "id", max_columns: int = 2000) -> DataFrame:
    """All records in one wide table under the union schema.

    Columns record_id, file_id, and ``f_<column>`` for each property, of the type that the lattice
    gives it, which holds every value that occurs (text where types don't go together). Two fields of a record that
    lead to one column: the larger text is kept, the other one is a row of :func:`displaced`.
    """
    heads = checkpointed(headers(records))  # a row per file and field, used several times
    names = checkpointed(field_names(files, records, item_key, heads))
    schema = union_schema(heads, names, max_columns)
    kinds = {c: SQL_TYPES[t] for c, t in schema.items()}
    # each record is parsed once, its fields take their column's name from its file's map, and the columns are looked up
    by_file = names.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "column_name"))).alias("_names"))
    text = F.when(F.try_parse_json("payload").isNotNull(), F.from_json("payload", "map<string,string>"))
    held = records.select("record_id", "file_id", text.alias("_doc")).join(by_file, "file_id", "left")
    entries = F.transform(F.map_entries("_doc"), lambda e: F.named_struct(F.lit("k"), F.try_element_at("_names", e["key"]), F.lit("v"), e["value"]))
    ordered = F.array_sort(F.filter(entries, lambda e: e["k"].isNotNull() & e["v"].isNotNull()))
    last = F.filter("_sorted", lambda e, i: F.coalesce(F.get("_sorted", i + 1)["k"] != e["k"], F.lit(True)))
    keyed = held.withColumn("_sorted", ordered).select("record_id", "file_id", F.map_from_entries(last).alias("_map"))

    def cell(c: str) -> Column:
        col = F.try_element_at("_map", F.lit(c))
        if kinds[c] == "double":
            return F.when(F.lower(col).isin("true", "false"), (F.lower(col) == "true").cast("double")).otherwise(col.try_cast("double")).alias(f"f_{c}")
        return col.try_cast(kinds[c]).alias(f"f_{c}")

    return keyed.select("record_id", "file_id", *[cell(c) for c in kinds])
