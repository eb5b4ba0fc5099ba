"""Data quality: column profiles, value counts, validation rules, fills, source statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: column_name, n_rows, null_percent, n_unique, min, max, mean, std (4 decimals; numbers only).

    std is the sample deviation, 0 for a single value. Distinct values are counted over (column, value) rows, which are grouped where they
    lie first, so that no row is copied for each column.
    """
    columns = columns or df.columns
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        x = F.col(c)
        as_number = x.cast("double") if c in numeric else F.lit(None).cast("double")
        aggs += [
            F.struct(
                F.count(x).alias("n"), F.min(as_number).alias("lo"), F.max(as_number).alias("hi"), F.avg(as_number).alias("mean"),
                F.when(F.count(as_number) > 1, F.stddev_samp(as_number)).when(F.count(as_number) == 1, 0.0).alias("std"),
            ).alias(f"_c{i}")
        ]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("s")) for i, c in enumerate(columns)])
    text = lambda c: F.to_json(F.struct(F.col(c).alias("x")), {"ignoreNullFields": "false"}) if "<" in dict(df.dtypes)[c] else (F.col(c) + 0.0 if dict(df.dtypes)[c] in ("double", "float") else F.col(c)).cast("string")
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).isNotNull(), text(c)).alias("v")) for c in columns]))).where(F.col("v").isNotNull())
    unique = values.groupBy("column_name", "v").agg(F.lit(1).alias("one")).groupBy("column_name").agg(F.count(F.lit(1)).alias("u"))
    long = wide.select("_n", F.inline(rows)).join(unique, "column_name", "left").fillna(0, ["u"])
    share = F.when(F.col("_n") > 0, F.round(100.0 * (F.col("_n") - F.col("s.n")) / F.col("_n"), 4)).otherwise(0.0)
    return long.select(
        "column_name", F.col("_n").alias("n_rows"), share.alias("null_percent"), F.col("u").alias("n_unique"),
        *[F.round(f"s.{k}", 4).alias(f"{name}_value") for k, name in (("lo", "min"), ("hi", "max"), ("mean", "mean"), ("std", "std"))],
    )


def alerts(profiled: DataFrame, column_percent: float = 50.0, overall_percent: float = 25.0) -> DataFrame:
    """Alerts of a profile: level (column or overall), subject, percent; an empty table is an alert of its own."""
    columns = profiled.where(F.col("null_percent") >= column_percent).select(F.lit("column").alias("level"), F.col("column_name").alias("subject"), F.col("null_percent").alias("percent"))
    total = profiled.agg(F.avg("null_percent").alias("percent"), F.max("n_rows").alias("n"))
    overall = total.where((F.col("percent") >= overall_percent) | (F.col("n") == 0)).select(
        F.lit("overall").alias("level"), F.when(F.col("n") == 0, "empty").otherwise("nulls").alias("subject"), F.round("percent", 4).alias("percent")
    )
    return columns.unionByName(overall)


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """Commonest values of each column: column_name, value, n, rank; ties by value; nulls left out."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))).where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class Check:
    """A validation rule on a column: ``ok`` is true, false or null (null passes)."""

    rule: str
    column: str
    ok: Column


def not_null(c: str) -> Check:
    return Check("not_null", c, F.col(c).isNotNull())


def non_empty(c: str) -> Check:
    return Check("non_empty", c, F.length(c) > 0)


def at_least(c: str, least: float) -> Check:
    return Check("at_least", c, F.col(c) >= least)


def one_of(c: str, values: list[str]) -> Check:
    return Check("one_of", c, F.col(c).isin(*values))


def between(c: str, lo: float, hi: float) -> Check:
    return Check("between", c, F.col(c).between(lo, hi))


def matches(c: str, pattern: str) -> Check:
    return Check("matches", c, F.col(c).rlike(pattern))


def violations(df: DataFrame, checks: list[Check], unique: list[str] | None = None) -> DataFrame:
    """Number of rows that break each rule: rule, column_name, violations. One pass; unique keys by rows less distinct values."""
    unique = unique or []
    counts = [F.count_if(~F.coalesce(c.ok, F.lit(True))).alias(f"_v{i}") for i, c in enumerate(checks)]
    repeats = [(F.count(c) - F.count_distinct(c)).alias(f"_u{i}") for i, c in enumerate(unique)]
    wide = df.agg(*counts, *repeats)
    rows = [F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column_name"), F.col(f"_v{i}").alias("violations")) for i, c in enumerate(checks)]
    rows += [F.struct(F.lit("unique").alias("rule"), F.lit(c).alias("column_name"), F.col(f"_u{i}").alias("violations")) for i, c in enumerate(unique)]
    return wide.select(F.inline(F.array(*rows)))


def failing_rows(df: DataFrame, checks: list[Check], key: str) -> DataFrame:
    """The rules each row breaks: key, broken (array of rule:column); rows without any are left out."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c.ok, F.lit(True)), f"{c.rule}:{c.column}") for c in checks]))
    return df.select(key, broken.alias("broken")).where(F.size("broken") > 0)


def coerced(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to types, null where a value can't be."""
    return df.withColumns({c: (F.try_to_timestamp(F.col(c)) if t == "timestamp" else F.col(c).try_cast(t)) for c, t in types.items() if c in df.columns})


def filled(df: DataFrame, how: dict[str, str | float]) -> DataFrame:
    """Missing values filled: "drop", "mean", "median", "mode" (ties the smallest), or a literal, by column."""
    stats = {c: h for c, h in how.items() if h in ("mean", "median", "mode")}
    out = df.dropna(subset=[c for c, h in how.items() if h == "drop"]) if "drop" in how.values() else df
    if stats:
        agg = {"mean": F.avg, "median": F.median, "mode": lambda c: F.mode(c, True)}
        values = out.agg(*[agg[h](F.col(c)).alias(f"_f_{c}") for c, h in stats.items()])
        out = out.crossJoin(F.broadcast(values))  # a single row
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_f_{c}")) for c in stats}).drop(*[f"_f_{c}" for c in stats])
    literals = {c: h for c, h in how.items() if h not in ("drop", "mean", "median", "mode")}
    return out.fillna(literals) if literals else out


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value and their percentage of all: column, n, percent (2 decimals)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.round(100.0 * F.col("n") / F.col("_t"), 2).alias("percent"))


def constant_or_null(column: str) -> Column:
    """The one value of a column, or null if there are several or none (an aggregate)."""
    return F.when(F.count_distinct(column) == 1, F.max(column))
