"""Python functions that give rows, under a name that SQL can use."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


def _schema(schema: StructType | Callable[..., StructType], arguments: tuple[AnalyzeArgument, ...]) -> StructType:
    return schema if isinstance(schema, StructType) else schema(*arguments)


def row_function(
    spark: SparkSession, name: str, function: Callable[..., Iterable[tuple]], schema: StructType | Callable[..., StructType]
) -> None:
    """Make ``FROM t, LATERAL name(t.a, 4)`` give the tuples that ``function(a, 4)`` yields, beside each row of ``t``.

    ``schema`` may be a function of the call's arguments (their types, and values where they are constant), which
    Spark asks while it analyses the query; it may refuse a call by raising.
    """

    class Rows:
        @staticmethod
        def analyze(*arguments: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(_schema(schema, arguments))

        def eval(self, *values):
            yield from function(*values)

    spark.udtf.register(name, udtf(Rows))


def group_function(
    spark: SparkSession,
    name: str,
    make: Callable[..., object],
    schema: StructType | Callable[..., StructType],
    partition_by: list[str] | None = None,
    order_by: list[str] | None = None,
) -> None:
    """Make ``FROM name(30, TABLE(t) PARTITION BY k ORDER BY o)`` walk every group's rows with memory; the table comes last.

    ``make(30)`` is called once per group and gives an object with ``row(row)``, which may yield tuples for each row in order, and
    ``end()``, which may yield more when the group is over; it keeps what it needs in between, so a
    group of any size streams through it. ``partition_by`` and ``order_by`` state the grouping for callers, who then leave it out.
    """

    class Groups:
        def __init__(self):
            self._walk = None

        @staticmethod
        def analyze(*arguments: AnalyzeArgument) -> AnalyzeResult:
            if not arguments or not arguments[-1].isTable:
                raise ValueError(f"{name} needs a table as its last argument: TABLE(...)")
            return AnalyzeResult(
                _schema(schema, arguments),
                partitionBy=[PartitioningColumn(c) for c in partition_by or []],
                orderBy=[OrderingColumn(c) for c in order_by or []],
            )

        def eval(self, *values):
            if self._walk is None:
                self._walk = make(*values[:-1])
            yield from self._walk.row(values[-1]) or ()

        def terminate(self):
            if self._walk is not None:
                yield from self._walk.end() or ()

    spark.udtf.register(name, udtf(Groups))
