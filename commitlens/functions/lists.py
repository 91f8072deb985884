"""Array columns and their pipe-joined form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlens.functions.text import normalize

_PIPE = "[|]"


def pipe_join(c: Column) -> Column:
    return F.array_join(c, "|")


def pipe_split(c: Column) -> Column:
    return F.split(c, _PIPE)


def pipe_member(c: Column, value: Column | str) -> Column:
    """True if ``value`` is one of the pipe-joined items, compared without case."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.array_contains(pipe_split(F.lower(c)), F.lower(value))


def normalize_items(c: Column, legacy: bool = False) -> Column:
    """Lower-case the items and tidy their white space; an item with ``|`` becomes several.

    ``legacy`` keeps the empty item that an empty list turns into.
    """
    items = pipe_split(normalize(pipe_join(c), lowercase=True, white_space=True))
    return items if legacy else F.filter(items, lambda x: x != "")


def hyphenate(c: Column) -> Column:
    """Join the words of each keyword by hyphens, then sort."""
    return F.array_sort(F.transform(c, lambda x: F.replace(x, F.lit(" "), F.lit("-"))))


def distinct_sorted(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def first_distinct(c: Column, n: int = 100) -> Column:
    """The first ``n`` distinct items in sorted order."""
    return F.slice(distinct_sorted(c), 1, n)


def length(c: Column) -> Column:
    """Item count; null for a null list."""
    return F.when(c.isNotNull(), F.size(c))
