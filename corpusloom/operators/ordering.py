"""Ordered operators without one task per group: numbering and neighbours over range partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in range partitions of an order, each sorted, with the partition's number as ``_part``; fixed by a checkpoint."""
    by = [F.col(c).asc_nulls_first() for c in order]
    return checkpointed(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers 1..n in an order. Each partition numbers on from the rows before it; one count per partition reaches the driver."""
    spread = _ranged(df, order)
    sizes = {r["_part"]: r["n"] for r in spread.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, at = {}, 0
    for p in sorted(sizes):
        starts[p], at = at, at + sizes[p]
    if not starts:
        return spread.withColumn(name, F.lit(0).cast("long")).drop("_part")
    base = F.try_element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("_part"))
    w = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return spread.withColumn(name, (base + F.row_number().over(w)).cast("long")).drop("_part")


def followed(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Rows with the ``order`` value that comes next in their group as ``name``; null for the last.

    A group of any size lies in as many partitions as it needs; the first row of each partition (one per partition
    reaches the driver) is what follows the last row of the one before.
    """
    spread = _ranged(df, [group, order])
    firsts = {r["_part"]: r["f"] for r in spread.groupBy("_part").agg(F.min(F.struct(group, order)).alias("f")).collect()}
    w = Window.partitionBy("_part").orderBy(group, order)
    after = F.lead(F.struct(F.col(group).alias("g"), F.col(order).alias("o"))).over(w)
    here = spread.withColumn("_next", after)
    parts = sorted(firsts)
    across = [(p, firsts[q][0], firsts[q][1]) for p, q in zip(parts, parts[1:])]
    kinds = dict(df.dtypes)
    edges = df.sparkSession.createDataFrame(across, f"_part int, _g {kinds[group]}, _o {kinds[order]}")
    joined = here.join(F.broadcast(edges), "_part", "left")  # a row per partition
    following = F.coalesce(F.col("_next"), F.when(F.col("_g").isNotNull(), F.struct(F.col("_g").alias("g"), F.col("_o").alias("o"))))
    return joined.withColumn(name, F.when(following["g"] == F.col(group), following["o"])).drop("_part", "_next", "_g", "_o")


def filled_forward(df: DataFrame, value: str, within: list[str], order: str) -> DataFrame:
    """``value`` with nulls replaced by the last one before them in the order of their group.

    A group of any size lies in as many partitions as it needs; what a partition hands on to the next one (a row per partition
    reaches the driver) is the last value of the group it ends with.
    """
    group = F.to_json(F.struct(*within), {"ignoreNullFields": "false"})
    spread = _ranged(df, [*within, order]).withColumn("_g", group)
    place = F.struct(*within, order)
    ends = spread.groupBy("_part").agg(
        F.min_by("_g", place).alias("first"), F.max_by("_g", place).alias("last"), F.max_by(F.when(F.col(value).isNotNull(), F.struct("_g", value)), F.when(F.col(value).isNotNull(), place)).alias("held")
    )
    carried, at = [], (None, None)
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        carried.append((r["_part"], *at))
        if r["held"] is not None and r["held"]["_g"] == r["last"]:
            at = (r["last"], r["held"][value])
        elif not (r["first"] == r["last"] == at[0]):
            at = (None, None)
    edges = df.sparkSession.createDataFrame(carried, f"_part int, _cg string, _cv {dict(df.dtypes)[value]}")
    w = Window.partitionBy("_part", *within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(w), F.when(F.col("_cg") == F.col("_g"), F.col("_cv")))
    return spread.join(F.broadcast(edges), "_part", "left").withColumn(value, filled).select(*df.columns)  # a row per partition
