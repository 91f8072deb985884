"""Sorting, limits and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unlimited(limit: int | str | None) -> bool:
    """None, 0 and the text ``None`` all mean no limit."""
    return limit is None or limit == "None" or int(limit) == 0


def limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if unlimited(limit) else df.limit(int(limit))


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of each key, exact.

    Two rounds of ranking: the first spreads a key over ``salts`` tasks by map partition, so the task that ends
    up with a hot key sees at most ``salts * n`` rows of it. Spark cuts every map partition to ``n`` rows a key before
    either shuffle, for an ``n`` up to spark.sql.optimizer.windowGroupLimitThreshold. Any spread
    gives the same rows, provided ``order`` has no ties.
    """
    if salts > 1:
        by_salt = Window.partitionBy("_salt", *keys).orderBy(*order)
        df = (
            df.withColumn("_salt", F.spark_partition_id() % salts)
            .withColumn("_rank", F.row_number().over(by_salt))
            .where(F.col("_rank") <= n)
            .drop("_rank", "_salt")
        )
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by_key)).where(F.col("_rank") <= n).drop("_rank")


def first_children(df: DataFrame, parent: str, position: str, limit: int | None) -> DataFrame:
    """The first ``limit`` children of every parent by source position."""
    if unlimited(limit):
        return df
    return top_n_per_key(df, [parent], [F.col(position)], int(limit))


def best_first(df: DataFrame, scores: list[Column], tie_break: str, limit: int | None = None) -> DataFrame:
    """Descending by the scores, nulls last; Spark keeps only ``limit`` rows per task on the way."""
    ordered = df.orderBy(*[s.desc_nulls_last() for s in scores], F.asc(tie_break))
    return limited(ordered, limit)
