"""A contributor rollup that is kept as a table and brought up to date from newly arrived commits only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens import schemas
from commitlens.plans.stages import CONTRIBUTOR, commits_by_name, contributors_of
from commitlens.session import drop_path, path_exists, written

# Parts of the state; an update rewrites those that new commits fall into.
BUCKETS = 64

STATE = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*CONTRIBUTOR, "author_name")]
    + [T.StructField(c, T.LongType()) for c in ("commit_count", "lines_added", "lines_deleted", "lines_modified")]
    + [T.StructField(c, T.TimestampType()) for c in ("first_commit", "last_commit")]
)
_MANIFEST = "batch bigint, bucket int, path string, rows bigint"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*CONTRIBUTOR), F.lit(buckets)).cast("int")


def merged(*states: DataFrame) -> DataFrame:
    """States put together: counts and sums add up, dates keep the first and the last.

    A state has one row per contributor and name they signed with, so it merges in any order and
    grouping, with hash aggregation, and is cut to one row a key before it is shuffled.
    """
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    return whole.groupBy(*CONTRIBUTOR, "author_name").agg(
        *[F.sum(c).alias(c) for c in ("commit_count", "lines_added", "lines_deleted", "lines_modified")],
        F.min("first_commit").alias("first_commit"),
        F.max("last_commit").alias("last_commit"),
    )


class Rollup:
    """The state below ``path``: bucket files, and a manifest that says which of them are current.

    An update writes the touched buckets as new files beside the old ones and then appends the manifest's
    rows for them in one small file: that is the moment the update counts. A reader takes for each
    bucket the row of the latest batch, so it sees a whole update or nothing of it; a batch that is run again after it
    counted changes nothing, and one that died before leaves files nobody reads.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self._spark, self._path, self._buckets = spark, path.rstrip("/"), buckets

    def _manifest(self) -> DataFrame:
        return self._spark.read.schema(_MANIFEST).parquet(f"{self._path}/manifest")

    def current(self) -> dict[int, str]:
        """The current file folder of each bucket: at most as many rows as buckets."""
        latest = self._manifest().groupBy("bucket").agg(F.max_by("path", "batch").alias("path"))
        return {r["bucket"]: r["path"] for r in latest.collect()}

    def state(self, buckets: list[int] | None = None, spark: SparkSession | None = None) -> DataFrame:
        """All of the state, or that of some buckets: a row per contributor and name."""
        spark = spark or self._spark
        paths = [p for b, p in sorted(self.current().items()) if buckets is None or b in buckets]
        return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)

    def counted(self, batch: int) -> bool:
        return bool(self._manifest().where(F.col("batch") >= batch).limit(1).count())

    def add(self, commits: DataFrame, batch: int) -> None:
        """Merge one batch of commits into the buckets their contributors are in; the commits are read once."""
        if self.counted(batch):
            return
        new = written(commits_by_name(commits).withColumn("bucket", _bucket(self._buckets)), "rollup-new")
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
        if touched:
            whole = merged(self.state(touched, new.sparkSession), new.drop("bucket")).withColumn("bucket", _bucket(self._buckets))
            place = f"{self._path}/state/{batch}-{uuid.uuid4().hex}"
            # The aggregate's partitions hold whole keys of any bucket; brought together, a bucket is a few files.
            whole.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(place)
            sizes = self._spark.read.parquet(place).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
            rows = sizes.select(
                F.lit(batch).cast("bigint").alias("batch"),
                F.col("bucket").cast("int"),
                F.concat(F.lit(f"{place}/bucket="), "bucket").alias("path"),
                "rows",
            )
            rows.coalesce(1).write.mode("append").parquet(f"{self._path}/manifest")

    def update(self, source: str, progress: str, files_per_batch: int | None = None) -> None:
        """Bring the state up to date with the Parquet files of commits that are new in ``source``.

        ``progress`` remembers which files were read. Returns when everything that was there has been merged.
        """
        if not path_exists(self._spark, f"{self._path}/manifest"):
            # A file without rows gives the manifest a place to be read from.
            self._spark.createDataFrame([], _MANIFEST).coalesce(1).write.parquet(f"{self._path}/manifest")
        reader = self._spark.readStream.schema(schemas.COMMITS)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        stream = (
            reader.parquet(source)
            .writeStream.foreachBatch(self.add)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()

    def contributors(self) -> DataFrame:
        """One row per contributor, the same as ``stages.extract_contributors`` gives for all commits at once."""
        return contributors_of(self.state())

    def drop_superseded(self) -> int:
        """Remove bucket files that no current row names, for when no reader is at work; how many folders went."""
        current = set(self.current().values())
        every = {r["path"] for r in self._manifest().select("path").distinct().collect()}
        for path in sorted(every - current):
            drop_path(self._spark, path)
        return len(every - current)
