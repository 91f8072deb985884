"""Answers of a model kept by request, so that each distinct request is sent once, over all runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.operators.infer import Calls, ask_model
from commitlens.operators.joins import lookup_join
from commitlens.session import path_exists, written

LEDGER = "digest string, answer string"
# Requests in one task and thus in one file: what a lost task has to send again.
REQUESTS_PER_TASK = 2_000


def digest_of(request: Column, model: str = "") -> Column:
    """The key of a request: model and text; null for a null request."""
    return F.sha2(F.concat(F.lit(f"{model}\0"), request).cast("binary"), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(digest, answer), one row per request: two runs at the same time may both have asked."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).groupBy("digest").agg(F.min("answer").alias("answer"))


def missing_requests(requests: DataFrame, path: str) -> DataFrame:
    """The distinct (digest, request) the ledger has no answer for; only its digests are read."""
    spark = requests.sparkSession
    # Of a digest's rows every map task passes on one, so a request that many rows share is no hot key.
    distinct = requests.where(F.col("request").isNotNull()).groupBy("digest").agg(F.first("request").alias("request"))
    if not path_exists(spark, path):
        return distinct
    known = spark.read.schema(LEDGER).parquet(path).select("digest")
    return distinct.join(known, "digest", "left_anti")


def fill_ledger(
    requests: DataFrame,
    path: str,
    make_client: Callable[[], Callable],
    calls: Calls = Calls(),
    accept: Callable[[str], bool] | None = None,
    tasks: int | None = None,
    requests_per_task: int = REQUESTS_PER_TASK,
) -> None:
    """Send what is missing and append the answers to the ledger, task by task.

    Every task's file is in the ledger as soon as the task is done, not when all are: a job that
    fails or is stopped keeps what was answered, and the next run sends the rest. ``tasks`` is how many there are, and so the
    most clients at a time; by default as many as ``requests_per_task`` calls for. A request without a valid answer is not
    recorded and is missing again.
    """
    todo = written(missing_requests(requests, path), "requests")
    count = todo.count()
    if not count:
        return
    # Requests alone are spread, not the rows they came from.
    spread = todo.repartition(tasks or max(1, -(-count // requests_per_task)), "digest")
    answered = spread.select("digest", ask_model(F.col("request"), make_client, calls, accept).alias("answer"))
    (
        answered.where(F.col("answer").isNotNull())
        .write.mode("append")
        # A task's file goes to its place when the task commits.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .parquet(path)
    )


def with_answers(
    df: DataFrame,
    request: Column,
    path: str,
    make_client: Callable[[], Callable],
    calls: Calls = Calls(),
    accept: Callable[[str], bool] | None = None,
    out: str = "_text",
    model: str = "",
    tasks: int | None = None,
) -> DataFrame:
    """``df`` with the answer to each row's request, out of the ledger below ``path`` once that has them all.

    Equal requests of any rows, of this run or an earlier one, are one request. ``model`` is part of
    the key: another model is asked anew. A null request is not sent and has no answer.
    """
    keyed = df.withColumn("_digest", digest_of(request, model))
    fill_ledger(
        keyed.select(F.col("_digest").alias("digest"), request.alias("request")), path, make_client, calls, accept, tasks
    )
    answers = read_ledger(df.sparkSession, path).withColumnRenamed("answer", out)
    return lookup_join(keyed, answers, [("_digest", "digest")], "left").drop("_digest")
