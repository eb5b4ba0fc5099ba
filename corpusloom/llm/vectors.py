"""Unit vectors from embedding arrays, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def usable(name: str, size: int) -> Column:
    """Whether an embedding has ``size`` finite values and isn't all zero."""
    v = F.col(name)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) == size) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def usable_vectors(table: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """key as ``id`` (long) and ``v`` (array of float) of the rows with a usable embedding."""
    return table.where(usable(vector, size)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))


def stack(arrays: pd.Series) -> np.ndarray:
    """Rows of a column of arrays, or of the bytes of their floats, as a float64 matrix of unit vectors."""
    if isinstance(arrays.iloc[0], bytes | bytearray):
        x = np.frombuffer(b"".join(arrays), np.float32).reshape(len(arrays), -1).astype(np.float64)
    else:
        x = np.stack([np.asarray(a, np.float64) for a in arrays])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def packed(vectors: DataFrame, least: int = 8) -> DataFrame:
    """id and v as the bytes of its floats, checkpointed for repeated reading; spread over the cores where the table lies in few splits."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "v": [np.asarray(a, np.float32).tobytes() for a in f["v"]]})

    tasks = max(least, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    few = vectors.rdd.getNumPartitions() < min(tasks, vectors.sparkSession.sparkContext.defaultParallelism)
    return checkpointed((vectors.repartition(tasks) if few else vectors).mapInPandas(pack, "id long, v binary"))
