"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "commitlens", master: str | None = None, folder: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for; ``conf`` keys use ``__`` for dots.

    ``folder`` is the shared folder where the environment names none in spark.checkpoint.dir.
    """
    if folder and not SparkConf().get("spark.checkpoint.dir"):
        conf = {"spark__checkpoint__dir": folder} | conf
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return configured.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that are of no use once their reader is done."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(self._spark)}/{name}-{uuid.uuid4().hex}"
        self._paths.append(path)
        df.write.mode("errorifexists").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the tables. On Spark Connect, which has no file access, they are left to the folder's owner."""
        if getattr(self._spark, "_sc", None) is not None:
            for name in self._paths:
                drop_path(self._spark, name)
        self._paths.clear()


def _located(spark: SparkSession, name: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, name: str) -> bool:
    files, path = _located(spark, name)
    return files.exists(path)


def drop_path(spark: SparkSession, name: str) -> None:
    """Remove a folder and all that is in it."""
    files, path = _located(spark, name)
    files.delete(path, True)
