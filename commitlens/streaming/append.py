"""Stages that append: only the files that arrived since the last run are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append_new(
    spark: SparkSession,
    source: str,
    schema: StructType,
    stage: Callable[[DataFrame], DataFrame],
    output: str,
    progress: str,
    files_per_batch: int | None = None,
) -> None:
    """Run a row-by-row ``stage`` over the Parquet files new in ``source`` and append to ``output``.

    Stages that append can be run again as their input grows. ``progress`` remembers which files
    were read; each is read once, and a run that dies half way leaves nothing twice in the table as
    Spark reads it. Returns when everything that was there has been read. The stage must not group:
    rollups are run over the whole table.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = (
        stage(reader.parquet(source))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
