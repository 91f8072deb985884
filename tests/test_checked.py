import enum
import json
import struct
from dataclasses import dataclass
from typing import Annotated, Literal, Optional

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructType

from commitlens.functions import checked, pictures
from commitlens.functions.checked import Between
from commitlens.operators import tablefn
from commitlens.plans import guard


class Color(enum.Enum):
    RED = "red"
    BLUE = "blue"


@dataclass
class Inner:
    name: Annotated[str, Between(1, 3)]
    tags: list[str]


@dataclass
class Whole:
    n: Annotated[int, Between(1, 10)]
    x: float
    ok: bool
    color: Color
    size: Literal["s", "m"]
    maybe: Optional[Annotated[int, Between(low=5)]]
    inner: Inner
    many: Annotated[list[Inner], Between(high=2)]
    by: dict[str, list[int]]


GOOD = {
    "n": 10, "x": 1, "ok": False, "color": "red", "size": "m", "maybe": None, "inner": {"name": "abc", "tags": []},
    "many": [{"name": "a", "tags": ["t"]}], "by": {"k": [1, 2], "l": []},
}
BAD = [
    {"n": 0}, {"n": 11}, {"n": None}, {"n": "1"}, {"x": "a"}, {"ok": None}, {"color": "green"}, {"size": "l"}, {"maybe": 4}, {"inner": None},
    {"inner": {"name": "", "tags": []}}, {"inner": {"name": "abcd", "tags": []}}, {"inner": {"name": "a", "tags": [None]}}, {"inner": {"name": "a"}},
    {"many": [{"name": "a", "tags": []}] * 3}, {"many": [None]}, {"by": {"k": [None]}}, {"by": {"k": None}}, {"by": None},
]


def test_both_checks_agree(spark):
    fine = [GOOD, GOOD | {"maybe": 5}, GOOD | {"many": []}, GOOD | {"by": {}}, GOOD | {"x": 2.5}, GOOD | {"extra": 1}]
    texts = [json.dumps(a) for a in fine] + [json.dumps(GOOD | b) for b in BAD] + ["", "{", "[]", "null", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    made = [r.fits for r in df.select("i", checked.answer_of(F.col("t"), Whole).isNotNull().alias("fits")).orderBy("i").collect()]
    assert made == [True] * len(fine) + [False] * (len(texts) - len(fine))
    accept = checked.answer_check(Whole)
    assert [accept(t) for t in texts[:-1]] == made[:-1]


def test_schemas():
    kind = checked.schema_of(Whole)
    assert kind["by"].dataType == MapType(StringType(), ArrayType(LongType())) and kind["color"].dataType == StringType()
    assert kind["maybe"].dataType == LongType() and kind["many"].dataType.elementType == checked.schema_of(Inner)
    for wrong in (dict[int, str], int | str, complex):
        with pytest.raises(TypeError):
            checked.compiled(wrong)


def png(w, h, color):
    return b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)


def jpeg(w, h, n, segments=(), sof=0xC0):
    return b"\xff\xd8" + b"".join(b"\xff" + bytes([m]) + struct.pack(">H", len(d) + 2) + d for m, d in segments) + b"\xff" + bytes([sof]) + struct.pack(">HBHHB", 17, 8, h, w, n)


def test_picture_heads(spark):
    exif = [(0xE1, b"x" * 60_000)] * 3 + [(0xC4, b"\xff\xc0" * 9)]
    cases = [
        (png(3, 70_000, 6), ("png", 3, 70_000, 4)), (png(1, 1, 0), ("png", 1, 1, 1)), (png(1, 1, 5), None), (png(0, 1, 2), None), (png(9, 9, 2)[:20], None),
        (b"GIF87a" + struct.pack("<HH", 500, 2) + b"\0\0\0", ("gif", 500, 2, 3)), (b"GIF89a\1", None),
        (b"BM" + bytes(16) + struct.pack("<iiHH", 5, -6, 1, 32), ("bmp", 5, 6, 4)), (b"BM", None),
        (jpeg(640, 480, 3), ("jpeg", 640, 480, 3)), (jpeg(64, 48, 1, exif, 0xC2), ("jpeg", 64, 48, 1)), (jpeg(64, 48, 1, exif)[:-6], None),
        (jpeg(7, 8, 3, [(0xFE, b"c")] * 200), ("jpeg", 7, 8, 3)), (b"\xff\xd8\xff\xda\0\4ab\xff\xc0", None), (b"\xff\xd8\xff\xe0\0\0", None), (b"\xff\xd8\xff", None),
        (b"", None), (None, None), (b"text", None),
    ]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, b binary")
    got = [r.s for r in df.select("i", pictures.picture_size(F.col("b")).alias("s")).orderBy("i").collect()]
    assert [g and tuple(g) for g in got] == [w for _, w in cases]


def test_table_functions(spark):
    def pair(kind):
        return StructType().add("i", LongType()).add("v", kind)

    def repeated(text, times):
        for i in range(times if text else 0):
            yield i, text

    def schema(text, times):
        if times.value is None:
            raise ValueError("times is constant")
        return pair(text.dataType)

    tablefn.row_function(spark, "repeated", repeated, schema)
    spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "t string, n int").createOrReplaceTempView("texts")
    got = guard.checked(spark, "SELECT n, i, v FROM texts, LATERAL repeated(t, 2)")
    assert sorted(map(tuple, got.collect())) == [(1, 0, "a"), (1, 1, "a"), (3, 0, "b"), (3, 1, "b")]
    with pytest.raises(Exception, match="times is constant"):
        spark.sql("SELECT * FROM texts, LATERAL repeated(t, n)")

    class Last:
        def __init__(self):
            self.seen = []

        def row(self, row):
            self.seen.append(row["n"])

        def end(self):
            yield len(self.seen), str(self.seen)

    tablefn.group_function(spark, "last_seen", Last, pair(StringType()), ["k"], ["n"])
    spark.range(50).selectExpr("id % 3 AS k", "49 - id AS n").createOrReplaceTempView("groups")
    rows = guard.checked(spark, "SELECT * FROM last_seen(TABLE(groups))").collect()
    assert sorted(r.v for r in rows) == sorted(str([n for n in range(50) if (49 - n) % 3 == k]) for k in range(3))
    with pytest.raises(Exception, match="needs a table"):
        spark.sql("SELECT * FROM last_seen(1)")

