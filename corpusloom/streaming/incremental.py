"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import there


def once(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Each signature once within the watermark: repeats that arrive no later than ``late`` after it are dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def replayed(stream: DataFrame, at: str, since: Column) -> DataFrame:
    """Events at or after a cutoff; older ones are done."""
    return stream.where(F.col(at) >= since)


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Events per window and key, final when the watermark has passed the window."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), *keys, "n")


def latest_state(stream: DataFrame, key: str, at: str, value: str, deleted: str) -> DataFrame:
    """Upserts in any order: emits key, at, value, outcome (created, updated, deleted, stale) of each event.

    The last time of each key is kept, also of deleted ones, so that an event older than a deletion stays stale.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, alive = state.get if state.exists else (None, False)
        rows = pd.concat(list(frames)).sort_values("at", kind="stable")
        out = []
        for r in rows.itertuples():
            micros = int(pd.Timestamp(r.at).value // 1000)
            if last is not None and micros <= last:
                outcome = "stale"
            else:
                outcome = "deleted" if r.deleted else ("updated" if alive else "created")
                last, alive = micros, not r.deleted
            out.append((k[0], r.at, r.value, outcome))
        state.update((last, alive))
        yield pd.DataFrame(out, columns=["key", "at", "value", "outcome"])

    source = stream.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(value).cast("string").alias("value"), F.col(deleted).alias("deleted"))
    return source.groupBy("key").applyInPandasWithState(step, "key string, at timestamp, value string, outcome string", "last long, alive boolean", "append", GroupStateTimeout.NoTimeout)


def each_batch(stream: DataFrame, manifest_path: str, keys: list[str], process: Callable[[DataFrame], None]):  # noqa: ANN201
    """Writer that processes only unseen rows of each micro batch and adds them to a manifest once they are done."""

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        seen = spark.read.parquet(manifest_path).select(*keys) if there(spark, manifest_path) else batch.select(*keys).limit(0)
        fresh = batch.join(seen, keys, "left_anti").dropDuplicates(keys).persist()
        process(fresh)
        fresh.select(*keys).withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(manifest_path)
        fresh.unpersist()

    return stream.writeStream.foreachBatch(run)
