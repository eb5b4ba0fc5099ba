"""Processing of raw tables: names, categories, missing values, validation, statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from . import profile, registry


@dataclass(frozen=True)
class Processed:
    """Outcome of one data set."""

    rows: DataFrame
    violations: DataFrame
    tag: str


def normalized_names(df: DataFrame, variant: str = "snake") -> DataFrame:
    """Columns renamed: ``snake`` splits camel case, ``plain`` drops punctuation. Names that fall together are numbered."""
    rename = T.snake_name if variant == "snake" else T.plain_column_name
    names: list[str] = []
    for c in df.columns:
        name, n = rename(c), 2
        while name in names:
            name, n = f"{rename(c)}_{n}", n + 1
        names.append(name)
    return df.toDF(*names)


def with_key(df: DataFrame, dataset: str) -> DataFrame:
    """``id`` as the data set's key (weapons: weapon_id), if that isn't there."""
    key = {"armor": "armor_id", "bosses": "boss_id"}.get(dataset, f"{dataset.rstrip('s')}_id")
    return df.withColumnRenamed("id", key) if "id" in df.columns and key not in df.columns else df


#: Columns of each data set that hold a vocabulary, and its function.
VOCABULARIES = {"weapons": {"weapon_type": V.weapon_type}, "armor": {"armor_type": V.armor_type}, "items": {"category": V.item_category, "rarity": V.rarity}}


def process(df: DataFrame, dataset: str, fills: dict[str, str | float] | None = None) -> Processed:
    """A raw table of a data set in its canonical form, with what breaks its schema."""
    schema = registry.find(dataset)
    if schema is None:
        raise ValueError(f"no schema for {dataset}")
    named = with_key(normalized_names(df, "plain"), schema.dataset)
    for column, function in VOCABULARIES.get(schema.dataset, {}).items():
        if column in named.columns:
            named = named.withColumn(column, function(column))
    if fills:
        named = profile.filled(named, fills)
    rows, broken = registry.validate(named, schema)
    return Processed(rows, broken, schema.tag)


def statistics(df: DataFrame) -> DataFrame:
    """Per column: data_type, n_rows, nulls."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(f"_{i}").alias("nulls")) for i, (c, t) in enumerate(df.dtypes)])
    return wide.select("_n", F.inline(rows)).select("column_name", "data_type", F.col("_n").alias("n_rows"), "nulls")


def outcome_counts(outcomes: DataFrame, status: str = "status") -> DataFrame:
    return outcomes.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
