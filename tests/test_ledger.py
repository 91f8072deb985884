import os
import uuid

import pytest
from pyspark.sql import functions as F

from commitlens.operators import ledger
from commitlens.operators.infer import Calls
from commitlens.plans import stages

NO_WAIT = Calls(first_wait=0.0, longest_wait=0.0, attempts=1)


def counting(folder, refuse=(), die=None):
    """A client that leaves a file per call."""

    def make():
        def complete(request):
            if request == die:
                raise SystemError("the task dies")
            if request in refuse:
                raise ValueError(request)
            with open(os.path.join(folder, f"{request}-{uuid.uuid4().hex}"), "w"):
                return f"about {request}"

        return complete

    return make


def calls(folder):
    return sorted(n.rsplit("-", 1)[0] for n in os.listdir(folder))


@pytest.fixture
def places(tmp_path):
    made = tmp_path / "calls"
    made.mkdir()
    return str(tmp_path / "ledger"), str(made)


def rows(df):
    return sorted((r.n, r.answer) for r in df.select("n", "answer").collect())


def test_each_distinct_request_is_sent_once(spark, places):
    path, made = places
    df = spark.createDataFrame([(i, [None, "a", "b", "c"][i % 4]) for i in range(40)], "n int, request string")
    want = [(i, [None, "about a", "about b", "about c"][i % 4]) for i in range(40)]
    ask = lambda client, on=df, **more: ledger.with_answers(on, F.col("request"), path, client, NO_WAIT, out="answer", **more)
    some = ask(counting(made, refuse=("b",)))
    assert rows(some) == [(i, None if w == "about b" else w) for i, w in want]
    assert calls(made) == ["a", "c"]
    # A second run sends what has no answer, and a third nothing.
    assert rows(ask(counting(made))) == want
    assert calls(made) == ["a", "b", "c"]
    more = df.union(spark.createDataFrame([(99, "d")], "n int, request string"))
    assert rows(ask(counting(made), on=more)) == want + [(99, "about d")]
    assert calls(made) == ["a", "b", "c", "d"]
    # Another model is asked anew.
    assert rows(ask(counting(made), model="other")) == want
    assert calls(made) == ["a", "a", "b", "b", "c", "c", "d"]


def test_a_job_that_fails_keeps_the_answers_of_finished_tasks(spark, places):
    path, made = places
    df = spark.createDataFrame([(i, f"r{i:02}") for i in range(30)], "n int, request string")
    requests = df.select(ledger.digest_of(F.col("request")).alias("digest"), "request")
    strict = Calls(first_wait=0.0, longest_wait=0.0, attempts=1, on_error="fail")
    with pytest.raises(Exception, match="the task dies"):
        ledger.fill_ledger(requests, path, counting(made, die="r17"), strict, tasks=10)
    kept = ledger.read_ledger(spark, path)
    known = kept.count()
    assert 0 < known < 30
    missing = {r.request for r in ledger.missing_requests(requests, path).collect()}
    assert len(missing) == 30 - known and "r17" in missing
    before = len(calls(made))
    ledger.fill_ledger(requests, path, counting(made), strict, tasks=10)
    assert sorted(calls(made)[:0] + [r.answer for r in ledger.read_ledger(spark, path).collect()]) == [f"about r{i:02}" for i in range(30)]
    assert len(calls(made)) - before == len(missing)


def test_requests_of_any_kind(spark, places):
    path, made = places
    empty = spark.createDataFrame([], "n int, request string")
    assert rows(ledger.with_answers(empty, F.col("request"), path, counting(made), NO_WAIT, out="answer")) == []
    nulls = spark.createDataFrame([(1, None)], "n int, request string")
    assert rows(ledger.with_answers(nulls, F.col("request"), path, counting(made), NO_WAIT, out="answer")) == [(1, None)]
    assert calls(made) == []
    # Answers that two runs recorded for one request count once.
    for answer in ("y", "x"):
        spark.createDataFrame([("d", answer)], ledger.LEDGER).write.mode("append").parquet(path)
    assert [tuple(r) for r in ledger.read_ledger(spark, path).collect()] == [("d", "x")]


def test_the_rows_are_not_shuffled_for_the_calls(spark, places):
    path, made = places
    df = spark.createDataFrame([(i, f"r{i % 3}") for i in range(12)], "n int, request string")
    out = ledger.with_answers(df, F.col("request"), path, counting(made), NO_WAIT, out="answer")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan and "Repartition" not in plan
    assert len(calls(made)) == 3


def test_a_stage_asks_through_the_ledger(spark, places):
    path, made = places
    pictures = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"b")), (3, bytearray(b"a")), (4, None)], "n int, profile_pic binary")

    def make():
        def complete(request):
            with open(os.path.join(made, f"call-{uuid.uuid4().hex}"), "w"):
                return '{"score": 1.5, "reason": "fine"}'

        return complete

    for _ in range(2):
        scored = stages.score_images(pictures, make, calls=NO_WAIT, kept=path)
        assert sorted((r.n, r.profile_pic_score) for r in scored.collect()) == [(1, 1.5), (2, 1.5), (3, 1.5), (4, None)]
        assert len(calls(made)) == 2
