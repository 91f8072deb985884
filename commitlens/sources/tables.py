"""Parquet and in-memory tables, named views and what was written."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commitlens.session import path_exists

MANIFEST = "path string, bytes bigint"


def inline_table(spark: SparkSession, columns: dict[str, list], schema: str | StructType) -> DataFrame:
    """A small table given column by column."""
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet file or directory; with a schema no file is opened before the job runs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def public_bucket_conf(region: str = "us-west-2") -> dict[str, str]:
    """Hadoop settings for reading an object store without credentials, to set when building the session."""
    return {
        "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
        "spark.hadoop.fs.s3a.endpoint.region": region,
    }


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    return spark.createDataFrame(table)


def to_arrow(df: DataFrame) -> pa.Table:
    """For results of known small size: everything goes to the driver."""
    return df.toArrow()


def to_rows(df: DataFrame) -> list[dict[str, Any]]:
    """Nested dicts, for results of known small size such as a limited answer."""
    return [row.asDict(recursive=True) for row in df.collect()]


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    rows_per_file: int | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write Parquet, appending unless told to overwrite; returns the files that this write made.

    With ``rows_per_file`` the files are sized: rows that go to one folder are brought together into tasks of
    about the advisory partition size while the job runs, a large folder in several tasks, and no file has
    more rows than that. Without it a task writes a file per folder it has rows for.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    before = _listed(df.sparkSession, path) if mode == "append" else {}
    folders = list(partition_by or [])
    if rows_per_file is not None:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in folders])
    writer = df.write.mode(mode)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*folders) if folders else writer).parquet(path)
    made = [(p, size) for p, size in _listed(df.sparkSession, path).items() if p not in before]
    return df.sparkSession.createDataFrame(sorted(made), MANIFEST)


def _listed(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files below ``path`` and their sizes: names only, no file is opened."""
    if not path_exists(spark, path):
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return {r["path"]: r["length"] for r in files.load(path).select("path", "length").collect()}


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All files of a table: (path, bytes). ``write_table`` returns those of its own write."""
    return spark.createDataFrame(sorted(_listed(spark, path).items()), MANIFEST)


def file_rows(files: DataFrame) -> DataFrame:
    """``files`` with the ``rows`` of each, read from nothing but the files named."""
    spark = files.sparkSession
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return files.withColumn("rows", F.lit(0).cast("bigint"))
    counted = spark.read.parquet(*paths).groupBy(F.input_file_name().alias("_file")).agg(F.count(F.lit(1)).alias("rows"))
    name = F.element_at(F.split("path", "/"), -1) == F.element_at(F.split(F.col("_file"), "/"), -1)
    # A write's file names are its own, but folders have files of equal names; whole paths differ in their scheme's slashes.
    place = F.regexp_replace("path", "^file:/+", "/") == F.url_decode(F.regexp_replace("_file", "^file:/+", "/"))
    return files.join(F.broadcast(counted), name & place, "left").drop("_file").fillna(0, ["rows"])


def preview(df: DataFrame, rows: int = 8, full: bool = False) -> None:
    df.show(rows, truncate=not full)


def keep(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cache, fill the cache, and show ``rows`` of it if asked."""
    df = df.persist()
    df.count()
    if rows:
        preview(df, rows)
    return df


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
