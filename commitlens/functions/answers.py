"""Typed answers out of a model's JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_answer(c: Column, schema: StructType, bounds: dict[str, tuple[int, int]] | None = None) -> Column:
    """Struct from JSON text; null unless every field is there, typed right and within its bounds."""
    parsed = F.from_json(c, schema)
    valid = F.lit(True)
    for field in schema.fieldNames():
        valid = valid & parsed[field].isNotNull()
    for field, (low, high) in (bounds or {}).items():
        valid = valid & parsed[field].between(low, high)
    return F.when(valid, parsed)


# Both scores of a contributor lie in this range.
QUALITY_BOUNDS = {"impact_to_project": (1, 10), "technical_ability": (1, 10)}
