"""A model class as a Spark schema and as checks of what came back."""

from __future__ import annotations

import dataclasses
import enum
import json
import types
import typing
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructField, StructType

Passes = Callable[[Column], Column]
Accepts = Callable[[object], bool]


@dataclasses.dataclass(frozen=True)
class Between:
    """Bounds of a number, or of the length of a text, list or map: ``Annotated[int, Between(1, 10)]``; None is open."""

    low: float | None = None
    high: float | None = None


@dataclasses.dataclass(frozen=True)
class Compiled:
    """One annotation: its type, a test of a column, and the same test of a value out of JSON."""

    kind: DataType
    passes: Passes
    accepts: Accepts
    optional: bool = False


def _plain(kind: DataType, python: type | tuple) -> Compiled:
    # True is an int in Python, but not in JSON.
    def accepts(v: object) -> bool:
        return isinstance(v, python) and isinstance(v, bool) == (python is bool)

    return Compiled(kind, lambda c: c.isNotNull(), accepts)


_PLAIN = {
    str: _plain(StringType(), str),
    int: _plain(LongType(), int),
    float: _plain(DoubleType(), (int, float)),
    bool: _plain(BooleanType(), bool),
}


def _or_null(inner: Compiled) -> Compiled:
    return Compiled(inner.kind, lambda c: c.isNull() | inner.passes(c), lambda v: v is None or inner.accepts(v), True)


def _listed(inner: Compiled) -> Compiled:
    return Compiled(
        ArrayType(inner.kind),
        lambda c: c.isNotNull() & F.forall(c, inner.passes),
        lambda v: isinstance(v, list) and all(map(inner.accepts, v)),
    )


def _mapped(inner: Compiled) -> Compiled:
    return Compiled(
        MapType(StringType(), inner.kind),
        lambda c: c.isNotNull() & F.forall(F.map_values(c), inner.passes),
        lambda v: isinstance(v, dict) and all(map(inner.accepts, v.values())),
    )


def _one_of(values: list[str]) -> Compiled:
    return Compiled(StringType(), lambda c: F.coalesce(c.isin(*values), F.lit(False)), lambda v: isinstance(v, str) and v in values)


def _within(inner: Compiled, bounds: Between) -> Compiled:
    sized = isinstance(inner.kind, (StringType, ArrayType, MapType))

    def passes(c: Column) -> Column:
        n = F.length(c) if isinstance(inner.kind, StringType) else F.size(c) if sized else c
        inside = F.lit(True)
        if bounds.low is not None:
            inside = inside & (n >= bounds.low)
        if bounds.high is not None:
            inside = inside & (n <= bounds.high)
        return inner.passes(c) & (c.isNull() | inside)

    def accepts(v: object) -> bool:
        if not inner.accepts(v):
            return False
        n = len(v) if sized and v is not None else v
        return v is None or ((bounds.low is None or n >= bounds.low) and (bounds.high is None or n <= bounds.high))

    return Compiled(inner.kind, passes, accepts, inner.optional)


def _record(model: type) -> Compiled:
    hints = typing.get_type_hints(model, include_extras=True)
    fields = {f.name: compiled(hints[f.name]) for f in dataclasses.fields(model)}

    def passes(c: Column) -> Column:
        fine = c.isNotNull()
        for name, field in fields.items():
            fine = fine & field.passes(c[name])
        return fine

    def accepts(v: object) -> bool:
        return isinstance(v, dict) and all(f.accepts(v.get(name)) for name, f in fields.items())

    return Compiled(StructType([StructField(n, f.kind) for n, f in fields.items()]), passes, accepts)


def compiled(annotation) -> Compiled:
    """Schema and checks of a class or annotation: dataclasses, str, int, float, bool, ``list``, ``dict[str, …]``, Optional, Enum, Literal, bounds."""
    origin, inner = typing.get_origin(annotation), typing.get_args(annotation)
    if origin is typing.Annotated:
        out = compiled(inner[0])
        for bounds in inner[1:]:
            if isinstance(bounds, Between):
                out = _within(out, bounds)
        return out
    if origin in (typing.Union, types.UnionType):
        known = [a for a in inner if a is not type(None)]
        if len(known) != 1 or len(known) == len(inner):
            raise TypeError(f"{annotation}: of unions only Optional has a schema")
        return _or_null(compiled(known[0]))
    if origin is list:
        return _listed(compiled(inner[0]))
    if origin is dict:
        if inner[0] is not str:
            raise TypeError(f"{annotation}: keys of JSON are text")
        return _mapped(compiled(inner[1]))
    if origin is typing.Literal:
        return _one_of(list(inner))
    if isinstance(annotation, type) and issubclass(annotation, enum.Enum):
        return _one_of([m.value for m in annotation])
    if dataclasses.is_dataclass(annotation):
        return _record(annotation)
    if annotation not in _PLAIN:
        raise TypeError(f"{annotation} has no schema")
    return _PLAIN[annotation]


def schema_of(model: type) -> StructType:
    """Struct type of a dataclass."""
    return compiled(model).kind


def answer_of(text: Column, model: type) -> Column:
    """The class's struct out of JSON text, null unless the whole of it passes; checked by Spark, without Python."""
    made = compiled(model)
    parsed = F.from_json(text, made.kind)
    return F.when(F.coalesce(made.passes(parsed), F.lit(False)), parsed)


def answer_check(model: type) -> Callable[[str], bool]:
    """A test for ``infer.ask_model``: does the text hold an answer of the class?"""
    made = compiled(model)

    def accept(text: str) -> bool:
        try:
            return made.accepts(json.loads(text))
        except ValueError:
            return False

    return accept
