"""Long exact spans shared between records, and how much of each record is shared.

A character is shared if it lies in a run of at least ``least`` characters that another record also holds,
that is, if some window of exactly ``least`` characters around it also stands in another record. So windows are
compared, by 64-bit rolling hashes of code points, never pairs of records: a passage in a third of all
records is one group that is reduced where its rows lie.

Most windows are ruled out first. Every window of ``least`` characters holds the smallest of its inner
hashes (of ``anchor`` characters); equal windows hold equal ones. Only these anchors, about two in a hundred characters,
are grouped over all records. Windows around anchors that stand in one record alone can't be shared, and
only the others are hashed and grouped in full.

Suffix automata of reference shards, which this problem's list names, give the same spans, but each shard's
automaton has to meet every record (shards x records), and built in Python an automaton takes microseconds
per character; README has the figures.

Defined cases: null, empty and short texts share nothing; repeats within one record don't count; copies of
a whole text share all of it; overlapping and touching spans are one; characters are code points; an empty
table gives no rows; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hasher:
    """Hashes of all windows of a text, from prefix sums of its characters times powers of a base."""

    def __init__(self) -> None:
        self.up, self.down = _powers(1 << 12)

    def windows(self, codes: np.ndarray, width: int) -> np.ndarray:
        """Hash of each window of ``width`` code points, by its start."""
        n = len(codes)
        if n > len(self.up):
            self.up, self.down = _powers(1 << int(n).bit_length())
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * self.up[:n], dtype=np.uint64)])
            return _mix((sums[width:] - sums[:-width]) * self.down[: n - width + 1])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _runs(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows: start and length."""
    starts = np.unique(starts)
    first = np.concatenate([[True], starts[1:] > starts[:-1] + width])
    last = np.concatenate([first[1:], [True]])
    return starts[first], starts[last] + width - starts[first]


def shared_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = 200) -> DataFrame:
    """Maximal runs of shared characters: key, span_start, span_len."""
    anchor = least // 2
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = documents.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where(F.length("t") >= least)
    # equal texts are one: the rest of the work is done once for all copies
    copies = long.groupBy(F.sha2("t", 256).alias("same")).agg(F.min(F.struct("k", "t")).alias("one"), F.count(F.lit(1)).alias("n"))
    texts = checkpointed(copies.select("same", F.col("one.k").alias("k"), F.col("one.t").alias("t"), "n").repartition(max(tasks, 12)))

    def anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for f in frames:
            ks, hs = [], []
            for k, t in zip(f["k"], f["t"]):
                found = np.unique(smallest_in(hasher.windows(code_points(t), anchor), least - anchor + 1))
                ks.append(np.full(len(found), k))
                hs.append(found)
            if ks:
                yield pd.DataFrame({"k": np.concatenate(ks), "h": np.concatenate(hs).view(np.int64)})

    held = texts.select("k", "t").mapInPandas(anchors, "k long, h long")
    common = held.groupBy("h").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a < b").select("h")
    wanted = held.join(common.hint("merge"), "h").groupBy("k").agg(F.collect_list("h").alias("hs"))
    near = texts.select("k", "t").join(wanted.hint("merge"), "k")

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for f in frames:
            for k, t, hs in zip(f["k"], f["t"], f["hs"]):
                codes = code_points(t)
                small = smallest_in(hasher.windows(codes, anchor), least - anchor + 1)
                at = np.flatnonzero(np.isin(small, np.asarray(hs, np.int64).view(np.uint64)))
                w = hasher.windows(codes, least)[at]
                yield pd.DataFrame({"k": np.full(len(at), k), "p": at.astype(np.int32), "w": w.view(np.int64), "h": small[at].view(np.int64)})

    # two windows are one if their hash and that of their anchor are, so that chance can only strike among windows around one anchor
    seen = near.mapInPandas(windows, "k long, p int, w long, h long")
    both = seen.groupBy("w", "h").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a < b").select("w", "h")
    starts = seen.join(both.hint("merge"), ["w", "h"]).groupBy("k").agg(F.collect_list("p").alias("ps"))
    once = texts.where("n = 1").select("k").join(starts.hint("merge"), "k")

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k, ps in zip(f["k"], f["ps"]):
                start, length = _runs(np.asarray(ps), least)
                yield pd.DataFrame({"k": np.full(len(start), k), "span_start": start, "span_len": length})

    parts = once.mapInPandas(merge, "k long, span_start int, span_len int")
    twice = copies.where("n > 1").select("same")
    whole = long.select("k", F.sha2("t", 256).alias("same"), F.length("t").alias("span_len")).join(twice.hint("merge"), "same").select("k", F.lit(0).alias("span_start"), "span_len")
    return parts.unionByName(whole).withColumnRenamed("k", key)


def shared_share(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = 200) -> DataFrame:
    """How much of each record stands elsewhere too: key, n_chars, shared_chars, n_spans, shared_share (null for null or empty text)."""
    spans = shared_spans(documents, key, text, least).groupBy(key).agg(F.sum("span_len").alias("shared_chars"), F.count(F.lit(1)).alias("n_spans"))
    sizes = documents.select(F.col(key).cast("long").alias(key), F.length(text).alias("n_chars"))
    joined = sizes.join(spans, key, "left").fillna(0, ["shared_chars", "n_spans"])
    return joined.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)))
