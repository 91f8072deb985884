"""What SQL that somebody else wrote may do, and for how long."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows one side of a join without an equality may have at most.
SMALL_SIDE = 1_000
# How often a run that is over its time is cancelled again: it may be between two jobs.
_AGAIN = 0.25

_PLANS = "org.apache.spark.sql.catalyst.plans.logical."
_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
_OUTSIDE = {
    _PLANS + "ScriptTransformation": "programs may not be run",
    _EXPRESSIONS + "CallMethodViaReflection": "methods of the Java machine may not be called",
    _EXPRESSIONS + "TryReflect": "methods of the Java machine may not be called",
}


class NotAllowed(ValueError):
    """SQL that is not a plain question to the registered tables."""


class TookTooLong(RuntimeError):
    """A run that was cancelled when its time was over."""


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _nodes(plan) -> Iterator:
    """All nodes of a plan, those of its subqueries among them."""
    stack = [plan]
    while stack:
        node = stack.pop()
        yield node
        stack += _items(node.children())
        stack += _items(node.subqueries())
        stack += [x for x in _items(node.innerChildren()) if hasattr(x, "subqueries")]


def _expressions(node) -> Iterator:
    stack = list(_items(node.expressions()))
    while stack:
        e = stack.pop()
        yield e
        stack += _items(e.children())


def _kind(node) -> str:
    return node.getClass().getName()


def _conjuncts(condition) -> Iterator:
    if _kind(condition) == _EXPRESSIONS + "And":
        yield from _conjuncts(condition.left())
        yield from _conjuncts(condition.right())
    else:
        yield condition


def _has_equality(join) -> bool:
    """Whether rows of both sides meet only where a value of one equals a value of the other."""
    if join.condition().isEmpty():
        return False
    left, right = join.left().outputSet(), join.right().outputSet()
    for c in _conjuncts(join.condition().get()):
        if _kind(c) in (_EXPRESSIONS + "EqualTo", _EXPRESSIONS + "EqualNullSafe"):
            a, b = c.left().references(), c.right().references()
            if a.nonEmpty() and b.nonEmpty() and (
                (a.subsetOf(left) and b.subsetOf(right)) or (a.subsetOf(right) and b.subsetOf(left))
            ):
                return True
    return False


def _bounded(side) -> bool:
    rows = side.maxRows()
    return rows.isDefined() and rows.get() <= SMALL_SIDE


def _statement(sql: str) -> str:
    return re.sub(r"[\s;]+\Z", "", sql)


def checked(spark: SparkSession, sql: str) -> DataFrame:
    """The rows of ``sql`` if it is a question and nothing more, else ``NotAllowed`` before anything has run.

    The text is put in brackets, as a subquery: commands, writes and several statements are no subquery, so
    the parser itself refuses them. The analysed plan must not run programs or call methods by name, nor
    read files that are no registered table. In the optimised plan a join has to have an equality between its sides
    or a side of at most ``SMALL_SIDE`` rows, by a limit or an aggregate, so nobody asks for all pairs of two tables.
    """
    inside = _statement(sql)
    if not inside:
        raise NotAllowed("an empty query")
    before = spark.conf.get("spark.sql.runSQLOnFiles", None)
    spark.conf.set("spark.sql.runSQLOnFiles", "false")
    try:
        # The line end closes a comment at the end of the text.
        result = spark.sql(f"SELECT * FROM (\n{inside}\n)")
    except Exception as error:
        if "PARSE_SYNTAX_ERROR" in str(error):
            raise NotAllowed(f"only one SELECT is allowed: {error}") from error
        raise
    finally:
        if before is None:
            spark.conf.unset("spark.sql.runSQLOnFiles")
        else:
            spark.conf.set("spark.sql.runSQLOnFiles", before)
    execution = result._jdf.queryExecution()
    for node in _nodes(execution.analyzed()):
        for part in [node, *_expressions(node)]:
            if (why := _OUTSIDE.get(_kind(part))) is not None:
                raise NotAllowed(why)
    for node in _nodes(execution.optimizedPlan()):
        if _kind(node) == _PLANS + "Join" and not _has_equality(node) and not (_bounded(node.left()) or _bounded(node.right())):
            raise NotAllowed("a join needs an equality between its two sides, or a LIMIT on one of them")
    return result


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[Callable[[], None]]:
    """Cancel the jobs started inside once ``seconds`` are over; then the block ends in ``TookTooLong``.

    The jobs carry a tag of their own, so no other work of the session is touched. Work may be several
    jobs: the tag is cancelled again and again until the block ends, and what the block is
    given raises as well, to be called between jobs.
    """
    if seconds is None:
        yield lambda: None
        return
    tag, ended, fired = f"limit-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def too_long() -> TookTooLong:
        return TookTooLong(f"cancelled after {seconds:g} seconds")

    def watch() -> None:
        if not ended.wait(seconds):
            fired.set()
            while not ended.is_set():
                spark.sparkContext.cancelJobsWithTag(tag)
                ended.wait(_AGAIN)

    def still_in_time() -> None:
        if fired.is_set():
            raise too_long()

    spark.sparkContext.addJobTag(tag)
    watcher = threading.Thread(target=watch, name=tag, daemon=True)
    watcher.start()
    try:
        yield still_in_time
        still_in_time()
    except Exception as error:
        if fired.is_set() and not isinstance(error, TookTooLong):
            raise too_long() from error
        raise
    finally:
        ended.set()
        watcher.join()
        spark.sparkContext.removeJobTag(tag)
