"""Fewer dimensions and clusters for vectors of texts, from Spark's own library.

The methods stand in for manifold learning and density clustering, which Spark doesn't have: principal components
for the former, k-means with a distance limit for noise for the latter. Results therefore differ from theirs; the tables made
from given labels (density, top motifs, exemplars) don't depend on the method.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity


def components(df: DataFrame, vector: str, n: int, name: str = "components") -> DataFrame:
    """First n principal components of the normalized vectors."""
    unit = df.withColumn("_v", array_to_vector(similarity.normalized(vector)))
    model = PCA(k=n, inputCol="_v", outputCol="_p").fit(unit.select("_v"))
    return model.transform(unit).withColumn(name, vector_to_array("_p")).drop("_v", "_p")


def clustered(df: DataFrame, vector: str, k: int, smallest: int = 10, farthest: float = 0.95, seed: int = 42) -> DataFrame:
    """Rows with cluster_id and cluster_probability. Noise is -1: rows beyond the ``farthest`` quantile of distance, and clusters under ``smallest``."""
    ready = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_c").fit(ready.select("_v"))
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "_c int, _m array<double>")
    placed = model.transform(ready).join(F.broadcast(centres), "_c").withColumn("_d", similarity.l2_distance(vector, "_m"))
    limit = placed.agg(F.percentile_approx("_d", farthest, 10_000).alias("_l"))
    sizes = placed.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    judged = placed.join(F.broadcast(sizes), "_c").crossJoin(F.broadcast(limit))
    noise = (F.col("_d") > F.col("_l")) | (F.col("_n") < smallest)
    return (
        judged.withColumn("cluster_id", F.when(noise, -1).otherwise(F.col("_c")))
        .withColumn("cluster_probability", F.when(noise, 0.0).otherwise(F.round(1 / (1 + F.col("_d")), 6)))
        .drop("_v", "_c", "_m", "_d", "_l", "_n")
    )


def sampled(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by a seeded hash of their key: the same ones wherever they lie (a sampling operator)."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
