"""Batched model calls as a column, and row-expanding functions."""

from __future__ import annotations

import asyncio
import dataclasses
import inspect
import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructType,
)

from commitlens.functions.checked import schema_of

__all__ = ["Calls", "answer_check", "ask_model", "expand", "in_tasks", "schema_of"]


@dataclasses.dataclass(frozen=True)
class Calls:
    """How a model is called: requests under way at once, attempts, waits and timeout in seconds.

    ``batch_size`` rows are sent and waited for before the next ones; by default an Arrow batch.
    """

    in_flight: int = 64
    batch_size: int | None = None
    attempts: int = 5
    first_wait: float = 4.0
    longest_wait: float = 60.0
    timeout: float | None = 60.0
    on_error: str = "null"

    def wait(self, failed: int) -> float:
        return min(max(self.first_wait, 2.0 ** (failed - 1)), self.longest_wait)


class _Caller:
    """One client with one event loop and one set of threads, for all batches of a task.

    A client may be bound to the loop it is first used in, so the loop lives as long as the client.
    Plain functions run in ``in_flight`` threads of their own; a call's time starts when it has
    begun, not while it waits for a thread.
    """

    def __init__(self, make_client: Callable[[], Callable], calls: Calls, accept: Callable[[str], bool] | None):
        self._calls, self._accept = calls, accept
        self._loop = asyncio.new_event_loop()
        self._threads = ThreadPoolExecutor(calls.in_flight, thread_name_prefix="model-call")
        self._call = make_client()
        # An async function or object is called in the loop; anything else may block and gets a thread.
        self._in_loop = inspect.iscoroutinefunction(self._call) or inspect.iscoroutinefunction(
            getattr(self._call, "__call__", None)
        )

    async def _once(self, request):
        if self._in_loop:
            return await asyncio.wait_for(self._call(request), self._calls.timeout)
        begun = asyncio.Event()

        def run():
            self._loop.call_soon_threadsafe(begun.set)
            return self._call(request)

        answer = self._loop.run_in_executor(self._threads, run)
        await asyncio.wait({answer, started := asyncio.ensure_future(begun.wait())}, return_when=asyncio.FIRST_COMPLETED)
        started.cancel()
        text = await asyncio.wait_for(answer, self._calls.timeout)
        # A plain function may hand back something to wait for, as a wrapper around an async one does.
        return await asyncio.wait_for(text, self._calls.timeout) if inspect.isawaitable(text) else text

    async def _one(self, request, slots: asyncio.Semaphore):
        calls = self._calls
        async with slots:
            for attempt in range(1, calls.attempts + 1):
                try:
                    text = await self._once(request)
                    if self._accept is not None and not self._accept(text):
                        raise ValueError("answer does not fit the model class")
                    return text
                except Exception:
                    if attempt < calls.attempts:
                        await asyncio.sleep(calls.wait(attempt))
                    elif calls.on_error == "fail":
                        raise
            return None

    async def _all(self, requests: list) -> list:
        slots = asyncio.Semaphore(self._calls.in_flight)
        # gather keeps the order of the requests, so every answer stays with its row.
        return await asyncio.gather(*[self._one(r, slots) for r in requests])

    def batch(self, requests: list) -> list:
        return self._loop.run_until_complete(self._all(requests))

    def close(self) -> None:
        """Let the client close in its loop if it can, then the loop; threads that hang are not waited for."""
        closing = getattr(self._call, "aclose", None) or getattr(self._call, "close", None)
        try:
            if callable(closing):
                done = closing()
                if inspect.isawaitable(done):
                    self._loop.run_until_complete(done)
            self._loop.run_until_complete(self._loop.shutdown_asyncgens())
        finally:
            self._threads.shutdown(wait=False, cancel_futures=True)
            self._loop.close()


def ask_model(
    request: Column,
    make_client: Callable[[], Callable],
    calls: Calls = Calls(),
    accept: Callable[[str], bool] | None = None,
) -> Column:
    """Answer text per request.

    ``make_client`` runs once per task and returns a function of one request: plain, async, or an object that can
    be called either way. It is also where credentials are read, so none travel with the plan.
    A null request is not sent. Only the request column goes to Python, in Spark's Arrow batches, of which
    ``calls.batch_size`` rows, if given, are sent and waited for at a time. Marked nondeterministic, so taking several
    fields of the answer never sends a request twice.
    """

    @F.pandas_udf("string")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        caller = _Caller(make_client, calls, accept)
        try:
            for batch in batches:
                sent = batch[batch.notna()]
                out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
                step = calls.batch_size or max(1, len(sent))
                for at in range(0, len(sent), step):
                    part = sent.iloc[at : at + step]
                    out.loc[part.index] = caller.batch(list(part))
                yield out
        finally:
            caller.close()

    return answers.asNondeterministic()(request)


_PLAIN = {StringType(): str, LongType(): int, DoubleType(): (int, float), BooleanType(): bool}


def _fits(value, kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return isinstance(value, list) and all(_fits(v, kind.elementType) for v in value)
    return isinstance(value, _PLAIN[kind]) and isinstance(value, bool) == (kind == BooleanType())


def answer_check(schema: StructType, bounds: dict[str, tuple[int, int]] | None = None) -> Callable[[str], bool]:
    """A test for ``ask_model``: is the text JSON with the fields of ``schema``, within bounds?

    With it an answer that does not fit is asked for again, as often as ``Calls`` allows.
    """
    fields = [(f.name, f.dataType) for f in schema.fields]
    limits = bounds or {}

    def accept(text: str) -> bool:
        try:
            answer = json.loads(text)
        except ValueError:
            return False
        if not isinstance(answer, dict) or not all(_fits(answer.get(name), kind) for name, kind in fields):
            return False
        return all(low <= answer[name] <= high for name, (low, high) in limits.items())

    return accept


def in_tasks(df: DataFrame, tasks: int | None) -> DataFrame:
    """Spread the rows over ``tasks`` tasks, which also caps how many clients run at a time."""
    return df if tasks is None else df.repartition(tasks)


def expand(
    df: DataFrame, function: Callable, arguments: list[str], schema: StructType, rows: int = 10_000, beside: list[str] | None = None, **extra
) -> DataFrame:
    """Each row becomes as many rows as ``function(*arguments, **extra)`` yields, possibly none.

    ``function`` yields tuples of ``schema``. What it yields leaves Python in Arrow batches of at most ``rows``
    rows as it comes, so one input row may become any number of rows; the input row's own columns are repeated beside them,
    or those that ``beside`` names: a long text that only ``function`` reads is best not copied for every row it yields.
    """
    names = list(df.columns)
    at = [names.index(a) for a in arguments]
    kept = names if beside is None else beside
    whole = StructType([*[df.schema[c] for c in kept], *schema.fields])

    def produced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.type for f in to_arrow_schema(schema)]
        for batch in batches:
            taken: list[int] = []
            made: list[tuple] = []
            values = [batch.column(i).to_pylist() for i in at]

            def flush():
                own = batch.select(kept).take(pa.array(taken, pa.int64()))  # noqa: B023
                new = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]  # noqa: B023
                return pa.RecordBatch.from_arrays([*own.columns, *new], names=whole.fieldNames())

            for i in range(batch.num_rows):
                for row in function(*(v[i] for v in values), **extra):
                    taken.append(i)
                    made.append(tuple(row))
                    if len(made) == rows:
                        yield flush()
                        taken, made = [], []
            if made:
                yield flush()

    return df.mapInArrow(produced, whole)
