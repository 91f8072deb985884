"""Helpers the operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of a batch that are Python objects at one time.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[..., Iterator[tuple] | list[tuple]]],
    schema: str,
) -> DataFrame:
    """Run Python over the columns of ``df``, an Arrow batch at a time.

    ``make`` is called once per task and gives a function from the batch's columns, as Python
    lists, to rows of ``schema``; it may get a batch in several slices. Only the columns of ``df`` travel, so select them first.
    """
    fields = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(fields)
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = list(work(*(c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns)))
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, fields)


def with_struct(df: DataFrame, column: str, schema: str, make: Callable, *inputs: str) -> DataFrame:
    """``df`` with a struct column that Python computes row by row from the ``inputs`` columns.

    ``make`` is called once per task and gives a function from one row's inputs to a tuple. The
    call is marked nondeterministic, so that reading several fields does not repeat it.
    """
    fields = T.StructType.fromDDL(schema)

    def run(batches: Iterator) -> Iterator[pa.Array]:
        kind = pa.struct([pa.field(f.name, f.type) for f in to_arrow_schema(fields)])
        work = make()
        names = fields.names
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)
            rows = zip(*(c.to_pylist() for c in columns), strict=True)
            yield pa.array([dict(zip(names, work(*r), strict=True)) for r in rows], kind)

    if len(inputs) == 1:

        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from run(batches)

        call = F.arrow_udf(one, fields)
    else:

        def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            yield from run(batches)

        call = F.arrow_udf(many, fields)
    return df.withColumn(column, call.asNondeterministic()(*inputs))


_TOOLS: dict = {}


def worker_tool(key: tuple | None, make: Callable | None = None):
    """What a Python worker keeps from task to task, made once: one tool at a time.

    Workers serve task after task, of other operators too. Asking for another tool, or for none,
    lets go of the one before with all it remembers, so a worker never holds two.
    """
    if key not in _TOOLS:
        _TOOLS.clear()
        gc.collect()
        if make is not None:
            _TOOLS[key] = make()
    return _TOOLS.get(key)


@contextmanager
def no_cycles() -> Iterator[None]:
    """Without Python's search for cycles, which walks all that a worker remembers each time many objects are made."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Memo:
    """What a function gives for a key, kept for the next time, in two generations of ``most`` keys.

    ``many`` computes a list of keys at once. When the younger generation is full it becomes the
    older one, which is forgotten in turn; what is asked for again moves up, so frequent keys stay.
    """

    def __init__(self, many: Callable[[list], list], most: int):
        self._many, self._most = many, most
        self._young: dict = {}
        self._old: dict = {}

    def look(self, keys: list) -> list:
        """The values of any sequence of keys, in order."""
        found = list(map(self._young.get, keys))
        if None in found:
            missing = {k for k, v in zip(keys, found, strict=True) if v is None}
            old = self._old
            fresh_ones = {k: old[k] for k in missing if k in old}
            new = [k for k in missing if k not in fresh_ones]
            if new:
                fresh_ones.update(zip(new, self._many(new), strict=True))
            found = [fresh_ones[k] if v is None else v for k, v in zip(keys, found, strict=True)]
            if len(self._young) + len(fresh_ones) > self._most:
                self._old, self._young = self._young, {}
            self._young.update(fresh_ones)
        return found
