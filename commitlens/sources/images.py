"""Picture files as columns."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.operators.joins import lookup_join


def below(path: str, directory: str) -> Column:
    """The part of a file's path below ``directory``: two files of one name in two folders differ."""
    root = urlsplit(directory).path.rstrip("/")
    return F.regexp_replace(path, f"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?{re.escape(root)}/+", "")


def with_bytes(df: DataFrame, directory: str, name: str, out: str) -> DataFrame:
    """Add the bytes of the file that column ``name`` says, a path below ``directory``; null where there is none."""
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    contents = files.select(below("path", directory).alias("_file"), F.col("content").alias(out))
    return lookup_join(df, contents, [(name, "_file")], "left")


def read_images(spark: SparkSession, directory: str) -> DataFrame:
    """(name, image) with path below ``directory``, height, width, channels and pixels; undecodable files are left out."""
    reader = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true")
    return reader.load(directory).select(below("image.origin", directory).alias("name"), "image")


def with_image(df: DataFrame, directory: str, name: str, out: str) -> DataFrame:
    """Add the decoded picture ``name`` under ``directory``; null where there is none or it is broken."""
    decoded = read_images(df.sparkSession, directory).select(F.col("name").alias("_file"), F.col("image").alias(out))
    return lookup_join(df, decoded, [(name, "_file")], "left")
