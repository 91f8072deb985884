import asyncio
import dataclasses
import functools
import json
import struct
import time
import zlib

import pytest
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql import functions as F

from commitlens import schemas
from commitlens.functions.answers import QUALITY_BOUNDS
from commitlens.operators import infer
from commitlens.plans import stages
from commitlens.sources import images

QUICK = infer.Calls(first_wait=0.0, longest_wait=0.0, attempts=3)


def ask(spark, requests, make_client, calls=QUICK, accept=None):
    df = spark.createDataFrame(list(enumerate(requests)), "i int, r string").repartition(2)
    got = df.withColumn("a", infer.ask_model(F.col("r"), make_client, calls, accept)).collect()
    return [r.a for r in sorted(got, key=lambda r: r.i)]


def test_order_is_kept_and_failures_are_null(spark):
    def client():
        async def call(request):
            await asyncio.sleep(0.02 if request.endswith("0") else 0)
            if request == "r3":
                raise ValueError("no")
            return request.upper()

        return call

    assert ask(spark, [f"r{i}" for i in range(12)] + [None], client) == [f"R{i}" if i != 3 else None for i in range(12)] + [None]


def test_retries_until_accepted(spark):
    calls = spark.sparkContext.accumulator(0)

    def client():
        tries = {}

        def call(request):
            calls.add(1)
            tries[request] = tries.get(request, 0) + 1
            if tries[request] == 1:
                raise ValueError("busy")
            return "bad" if tries[request] == 2 else "good"

        return call

    assert ask(spark, ["a", "b"], client, accept=lambda t: t == "good") == ["good", "good"]
    assert calls.value == 6
    assert ask(spark, ["a"], client, infer.Calls(first_wait=0, longest_wait=0, attempts=2), lambda t: t == "good") == [None]


def test_answer_check():
    check = infer.answer_check(schemas.COMMIT_QUALITY, QUALITY_BOUNDS)
    good = {"impact_to_project": 1, "technical_ability": 10, "reason": "r"}
    assert check(json.dumps(good))
    for change in ({"impact_to_project": 0}, {"technical_ability": 10.5}, {"reason": None}, {"impact_to_project": True}):
        assert not check(json.dumps(good | change))
    assert not check("sorry") and not check("[1]")
    projects = infer.answer_check(schemas.PROJECT_ANALYSIS)
    assert projects('{"languages": ["c"], "keywords": []}') and not projects('{"languages": [1], "keywords": []}')
    assert infer.answer_check(schemas.PICTURE_SCORE)('{"score": 3, "reason": ""}')


def test_failure_can_fail_the_job(spark):
    def client():
        def call(request):
            raise ValueError("down")

        return call

    with pytest.raises(Exception, match="down"):
        ask(spark, ["a"], client, infer.Calls(first_wait=0, longest_wait=0, attempts=1, on_error="fail"))


def test_timeout(spark):
    def client():
        async def call(request):
            await asyncio.sleep(30)

        return call

    assert ask(spark, ["a"], client, infer.Calls(attempts=1, timeout=0.05)) == [None]


def test_in_flight_is_capped(spark):
    def client():
        state = {"now": 0, "most": 0}

        async def call(request):
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
            await asyncio.sleep(0.01)
            state["now"] -= 1
            return str(state["most"])

        return call

    got = ask(spark, ["r"] * 40, client, infer.Calls(in_flight=3))
    assert max(int(x) for x in got) <= 3


def test_a_client_bound_to_its_loop_serves_all_batches(spark):
    """As real async clients do, it fails in any loop but the one it was first used in."""

    def client():
        state = {}

        class Client:
            async def __call__(self, request):
                loop = state.setdefault("loop", asyncio.get_running_loop())
                if asyncio.get_running_loop() is not loop:
                    raise RuntimeError("another loop")
                await asyncio.sleep(0)
                return request.upper()

            async def aclose(self):
                assert asyncio.get_running_loop() is state.get("loop", asyncio.get_running_loop())

        return Client()

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert ask(spark, [f"r{i}" for i in range(20)], client) == [f"R{i}" for i in range(20)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert ask(spark, [f"r{i}" for i in range(7)], client, dataclasses.replace(QUICK, batch_size=2)) == [f"R{i}" for i in range(7)]


def test_blocking_calls_get_a_thread_each_and_time_starts_with_the_call(spark):
    def client():
        def call(request):
            time.sleep(0.3)
            return request

        return call

    requests = [f"r{i}" for i in range(128)]
    df = spark.createDataFrame(list(enumerate(requests)), "i int, r string").coalesce(1)
    calls = infer.Calls(attempts=1, timeout=0.5, in_flight=64)
    started = time.monotonic()
    got = df.withColumn("a", infer.ask_model(F.col("r"), client, calls)).collect()
    assert sorted(r.a for r in got) == sorted(requests) and time.monotonic() - started < 15


def test_a_wrapper_may_return_something_to_wait_for(spark):
    def client():
        async def call(request):
            return request * 2

        return functools.partial(lambda f, r: f(r), call)

    assert ask(spark, ["a", None], client) == ["aa", None]


def test_batch_size_bounds_what_is_under_way(spark):
    def client():
        state = {"now": 0, "most": 0}

        async def call(request):
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
            await asyncio.sleep(0.005)
            state["now"] -= 1
            return str(state["most"])

        return call

    got = ask(spark, ["r"] * 30, client, dataclasses.replace(QUICK, batch_size=1))
    assert set(got) == {"1"}


def test_waits():
    calls = infer.Calls()
    assert [calls.wait(i) for i in range(1, 9)] == [4, 4, 4, 8, 16, 32, 60, 60]


def test_one_call_per_row_for_several_fields(spark):
    seen = spark.sparkContext.accumulator(0)

    def client():
        def call(request):
            seen.add(1)
            return '{"score": 1.5, "reason": "r"}'

        return call

    df = spark.createDataFrame([(bytearray(b"x"),), (None,)], "profile_pic binary")
    got = stages.score_images(df, client, calls=QUICK).where("profile_pic IS NOT NULL").collect()
    assert [(r.profile_pic_score, r.profile_pic_reason) for r in got] == [(1.5, "r")]
    assert seen.value == 1


def test_failed_picture_keeps_its_row(spark):
    def client():
        def call(request):
            if "YQ==" in request:
                raise ValueError
            return '{"score": 2.0, "reason": "b"}'

        return call

    df = spark.createDataFrame([("a", bytearray(b"a")), ("b", bytearray(b"b"))], "n string, profile_pic binary")
    got = {r.n: r.profile_pic_score for r in stages.score_images(df, client).collect()}
    assert got == {"a": None, "b": 2.0}


def test_expand(spark):
    @dataclasses.dataclass
    class Piece:
        at: int
        text: str

    def pieces(a, b, times):
        for i in range(times if b else 0):
            yield i, a

    df = spark.createDataFrame([("x", True, 1), ("y", False, 2)], "a string, b boolean, c int")
    got = infer.expand(df, pieces, ["a", "b"], infer.schema_of(Piece), times=2).collect()
    assert [tuple(r) for r in got] == [("x", True, 1, 0, "x"), ("x", True, 1, 1, "x")]
    many = infer.expand(df, pieces, ["a", "b"], infer.schema_of(Piece), rows=100, times=1_234)
    assert sorted(r.at for r in many.collect()) == list(range(1_234))
    assert infer.expand(df.where("false"), pieces, ["a", "b"], infer.schema_of(Piece), times=2).collect() == []


def test_expand_beside_named_columns(spark):
    """A text that only the function reads is not copied for every row it yields."""
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d")], "id bigint, text string")

    def words(text):
        yield from enumerate((text or "").split())

    found = infer.expand(df, words, ["text"], StructType().add("at", LongType()).add("word", StringType()), beside=["id"])
    assert found.columns == ["id", "at", "word"]
    assert sorted(map(tuple, found.collect())) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (3, 0, "d")]


def test_schema_of():
    @dataclasses.dataclass
    class Inner:
        ok: bool

    @dataclasses.dataclass
    class Model:
        score: float
        tags: list[str]
        inner: Inner

    assert infer.schema_of(Model).simpleString() == "struct<score:double,tags:array<string>,inner:struct<ok:boolean>>"


def png(width, height):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    pixels = b"".join(b"\0" + b"\x10\x20\x30" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(pixels)) + chunk(b"IEND", b"")


def test_pictures(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(3, 2))
    (tmp_path / "broken.png").write_bytes(b"not a picture")
    people = spark.createDataFrame([("ann", "a.png"), ("bob", "b.png"), ("cy", None)], "who string, file string")
    got = {r.who: r.pic for r in images.with_bytes(people, str(tmp_path), "file", "pic").collect()}
    assert bytes(got["ann"]) == png(3, 2) and got["bob"] is None and got["cy"] is None
    decoded = images.read_images(spark, str(tmp_path)).select("name", "image.width", "image.height", "image.nChannels").collect()
    assert [tuple(r) for r in decoded] == [("a.png", 3, 2, 3)]
    widths = {r.who: r.img and r.img.width for r in images.with_image(people, str(tmp_path), "file", "img").collect()}
    assert widths == {"ann": 3, "bob": None, "cy": None}
    # One name in two folders is two files.
    for folder, size in (("x", 4), ("y", 5)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.png").write_bytes(png(size, 2))
    people = spark.createDataFrame([("ann", "a.png"), ("dee", "x/a.png"), ("eve", "y/a.png")], "who string, file string")
    got = {r.who: bytes(r.pic) for r in images.with_bytes(people, f"file://{tmp_path}/", "file", "pic").collect()}
    assert got == {"ann": png(3, 2), "dee": png(4, 2), "eve": png(5, 2)}
    widths = {r.who: r.img.width for r in images.with_image(people, str(tmp_path), "file", "img").collect()}
    assert widths == {"ann": 3, "dee": 4, "eve": 5}
