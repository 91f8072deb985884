"""Instants and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: `2024-03-01 10:00:00 +0530`.
_COMMIT_DATE = "yyyy-MM-dd HH:mm:ss xx"


def commit_date(c: Column) -> Column:
    """Instant of a commit's ISO-like date; null if the text is something else."""
    return F.try_to_timestamp(c, F.lit(_COMMIT_DATE))


def as_text(c: Column) -> Column:
    return c.cast("string")


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def display_date(c: Column) -> Column:
    """Month/day/year without leading zeros, from a timestamp or its text."""
    return F.date_format(F.try_to_timestamp(c.cast("string")), "M/d/yyyy")
