"""Session helpers: defaults that suit a cluster, and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """Timestamps in the tables have no zone and are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints, which all executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only where that is unset, as on one
    machine in tests, a temporary folder is made.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and checkpoints of frames that nothing refers to anymore.

    It does so when the driver's garbage is collected, which otherwise may not happen before the end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _path(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, on a cluster's storage or this machine's."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def there(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists; an error of the storage is raised, not taken for absence."""
    at, system = _path(spark, path)
    return system.exists(at)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Paths of what a folder holds, sorted."""
    at, system = _path(spark, folder)
    return sorted(str(x.getPath().toString()) for x in system.listStatus(at))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return utc(spark).read.parquet(f"{folder}/{name}.parquet")
