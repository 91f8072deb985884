"""Naming an intermediate column inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` mentions it: expressions would grow with every mention."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def change_if(c: Column, test: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``c``, changed where the test holds."""
    return let(c, lambda v: F.when(test(v), change(v)).otherwise(v))
