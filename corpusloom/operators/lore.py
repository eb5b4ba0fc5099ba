"""Lore lines: entity texts to lines, weighted composition per entity, sections of documents, speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import filled_forward

# Weights of text types in composed texts; 1 for others.
WEIGHTS = {"description": 1.4, "impalers_excerpt": 1.7, "quote": 1.3, "dialogue": 0.7, "lore": 1.2, "effect": 0.7, "obtained_from": 0.8, "drops": 0.8}


def explode_texts(entities: DataFrame, canonical_id: str, columns: list[str], keep: list[str]) -> DataFrame:
    """A line for each filled text column of an entity: keep, canonical_id, text_type, text, lore_id."""
    long = entities.select(*keep, canonical_id, F.inline(F.array(*[F.struct(F.lit(c).alias("text_type"), T.lore_text(c).alias("text")) for c in columns])))
    return long.where(F.col("text") != "").withColumn("lore_id", T.lore_id(canonical_id, "text_type", "text"))


def union_lines(*parts: DataFrame) -> DataFrame:
    """Line sets one after another, each lore_id once (the first part that has it wins)."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    rest = F.struct(*[F.col(c) for c in out.columns if c != "lore_id"])
    kept = out.groupBy("lore_id").agg(F.min_by(rest, "_part").alias("r"))
    return kept.select("lore_id", *[F.col(f"r.{c}").alias(c) for c in out.columns if c not in ("lore_id", "_part")])


def weighted_texts(lines: DataFrame, canonical_id: str, text_type: str, text: str, ordinal: str, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per entity: its lines joined by text type, scaled by the type's weight, as labelled sections.

    Columns: canonical_id, text (sections unscaled), embedding_text (scaled), text_type (of the greatest weight),
    text_type_components, component_count. Sections stand by weight, then scaled length, descending, then first appearance.
    """
    weights = weights or WEIGHTS
    named = F.coalesce(F.col(text_type), F.lit(""))
    clean = lines.select(F.col(canonical_id).alias("c"), named.alias("t"), T.trim_space(text).alias("x"), F.col(ordinal).alias("o")).where((F.col("x") != "") & F.col("c").isNotNull())
    blocks = clean.groupBy("c", "t").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "x"))), lambda s: s["x"]), "\n\n").alias("block"), F.min("o").alias("seen"))
    known = F.create_map(*[F.lit(v) for kv in weights.items() for v in kv])
    weighed = blocks.withColumn("w", F.coalesce(F.try_element_at(known, F.lower(F.trim("t"))), F.lit(1.0))).withColumn("scaled", T.scale_block("block", F.col("w")))
    row = F.struct((-F.col("w")).alias("w"), (-F.length("scaled")).alias("l"), "seen", "t", "block", "scaled")
    per = weighed.groupBy("c").agg(F.array_sort(F.collect_list(row)).alias("s"))
    join = lambda field: F.array_join(F.filter(F.transform("s", lambda x: T.section(x["t"], x[field])), lambda y: y != ""), "\n\n")
    return per.select(
        F.col("c").alias(canonical_id),
        join("block").alias("text"),
        join("scaled").alias("embedding_text"),
        F.element_at("s", 1)["t"].alias("text_type"),
        F.array_join(F.transform("s", lambda x: x["t"]), "|").alias("text_type_components"),
        F.size("s").alias("component_count"),
    ).where((F.col("text") != "") & (F.col("embedding_text") != ""))


def weighting_stats(composed_blocks: DataFrame) -> DataFrame:
    """Block counts and median lengths by text type, of rows (text_type, original_length, weighted_length)."""
    return composed_blocks.groupBy("text_type").agg(
        F.count(F.lit(1)).alias("blocks"), F.median("original_length").alias("median_original"), F.median("weighted_length").alias("median_weighted")
    )


def joined_unique(lines: DataFrame, key: str, column: str, ordinal: str) -> DataFrame:
    """Distinct filled values of each key in order of first appearance, joined by a bar."""
    firsts = lines.where(F.trim(column) != "").groupBy(key, F.trim(column).alias("v")).agg(F.min(ordinal).alias("o"))
    return firsts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda x: x["v"]), "|").alias(column))


def lore_stats(lines: DataFrame, by: list[str], canonical_id: str) -> DataFrame:
    """Lines and entities by each value of each column: column_name, value, n_lines, n_entities."""
    long = lines.select(canonical_id, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in by])))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct(canonical_id).alias("n_entities"))


def multi_source(lines: DataFrame, canonical_id: str, source: str) -> DataFrame:
    """Entities with lines of several sources: canonical_id, n_sources."""
    return lines.where(F.col(canonical_id).isNotNull()).groupBy(canonical_id).agg(F.count_distinct(source).alias("n_sources")).where("n_sources > 1")


def speaker_audit(lines: DataFrame, found: DataFrame, prefix: str, canonical_id: str, line_id: str, text_type: str) -> DataFrame:
    """Speakers whose id starts with a prefix: lore_count, text types (map as JSON), motifs (sorted), motif_count."""
    own = lines.where(F.col(canonical_id).startswith(prefix))
    types = own.groupBy(canonical_id, text_type).agg(F.count(F.lit(1)).alias("n"))
    mapped = types.groupBy(canonical_id).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(text_type, "n"))))).alias("text_types"))
    counts = own.groupBy(canonical_id).agg(F.count_distinct(line_id).alias("lore_count"))
    motifs = found.where(F.col(canonical_id).startswith(prefix)).groupBy(canonical_id).agg(F.array_sort(F.collect_set("motif_slug")).alias("motifs"))
    out = counts.join(mapped, canonical_id, "left").join(motifs, canonical_id, "left")
    none = F.array().cast("array<string>")
    return out.withColumn("motifs", F.coalesce("motifs", none)).withColumn("motif_count", F.size("motifs"))


def forward_filled(df: DataFrame, value: str, within: list[str], order: str) -> DataFrame:
    """``value`` with nulls replaced by the last one before them in the order."""
    return filled_forward(df, value, within, order)
