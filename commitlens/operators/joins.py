"""Equi-joins with a lookup side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _prepared(lookup: DataFrame, on: list[str] | list[tuple[str, str]]) -> tuple[DataFrame, list[str], list[str], Column]:
    """The lookup side under other key names, both sides' keys and the condition."""
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    matches = F.lit(True)
    for i, (a, b) in enumerate(pairs):
        lookup = lookup.withColumnRenamed(b, f"_key_{i}")
        matches = matches & (F.col(a) == F.col(f"_key_{i}"))
    return lookup, [a for a, _ in pairs], [f"_key_{i}" for i in range(len(pairs))], matches


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: list[str] | list[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` that has one row per key; ``how`` is inner or left.

    Spark chooses: it broadcasts a lookup side it knows to be small, and otherwise shuffles both
    sides and splits partitions that turn out large, as a hot or a null key makes them, while the job
    runs. Key columns of the right side are dropped.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    lookup, _, right_keys, matches = _prepared(lookup, on)
    return facts.join(lookup, matches, how).drop(*right_keys)
