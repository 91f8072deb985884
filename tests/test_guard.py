import threading
import time

import pytest

from commitlens.plans import ask, guard
from commitlens.schemas import ANSWER_INPUT


@pytest.fixture
def tables(spark):
    spark.range(2000).selectExpr("id", "id % 10 AS k").createOrReplaceTempView("numbers")
    yield
    spark.catalog.dropTempView("numbers")


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT k, count(*) AS n FROM numbers GROUP BY k ORDER BY k;\n",
        "WITH a AS (SELECT * FROM numbers) SELECT a.k FROM a JOIN numbers b ON a.id = b.id AND a.k < b.k + 1 -- fine",
        "SELECT k FROM numbers WHERE id = (SELECT max(id) FROM numbers)",
        "SELECT n.k FROM numbers n CROSS JOIN (SELECT avg(k) AS m FROM numbers) WHERE n.k > m",
        "SELECT n.k FROM numbers n, (SELECT id FROM numbers LIMIT 5) f WHERE n.id > f.id",
        "SELECT k FROM numbers WHERE id IN (SELECT id FROM numbers WHERE k = 3) OR k = 4",
        "SELECT 1 AS k UNION ALL SELECT 2",
        "VALUES (1), (2)",
    ],
)
def test_questions_pass_and_give_what_they_ask(spark, tables, sql):
    want = spark.sql(sql.strip().rstrip(";"))
    assert sorted(guard.checked(spark, sql).collect()) == sorted(want.collect())


@pytest.mark.parametrize(
    "sql",
    [
        "",
        " ; ",
        "DROP VIEW numbers",
        "CREATE TABLE t AS SELECT 1",
        "INSERT INTO numbers VALUES (1, 2)",
        "SET spark.sql.ansi.enabled=false",
        "CACHE TABLE numbers",
        "SELECT 1; DROP VIEW numbers",
        "SELECT 1) ; DROP VIEW numbers --",
        "SELECT TRANSFORM(id) USING 'cat' AS (x) FROM numbers",
        "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
        "SELECT k FROM numbers WHERE id IN (SELECT length(java_method('java.lang.System', 'getProperty', 'user.home')))",
        "SELECT a.k FROM numbers a, numbers b",
        "SELECT a.k FROM numbers a JOIN numbers b ON a.id < b.id",
        "SELECT a.k FROM numbers a JOIN numbers b ON a.id = 3 AND a.k + b.k = 4",
        "SELECT k FROM numbers WHERE EXISTS (SELECT 1 FROM numbers a CROSS JOIN numbers b)",
    ],
)
def test_anything_else_is_refused_before_it_runs(spark, tables, sql):
    with pytest.raises(guard.NotAllowed):
        guard.checked(spark, sql)
    assert spark.catalog.tableExists("numbers")


def test_files_are_no_tables(spark, tables, tmp_path):
    path = str(tmp_path / "secret")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND|UNSUPPORTED"):
        guard.checked(spark, f"SELECT * FROM parquet.`{path}`")
    assert spark.sql(f"SELECT * FROM parquet.`{path}`").count() == 3


def test_a_run_is_cancelled_and_others_are_not(spark, tables):
    endless = spark.sql("SELECT r.id FROM range(100000000000000) r JOIN numbers n ON r.id % 7 = n.k - 20")
    other: list = []

    def work():
        time.sleep(0.5)
        other.append(spark.range(10_000_000).selectExpr("sum(id % 7)").collect())

    beside = threading.Thread(target=work)
    beside.start()
    started = time.monotonic()
    with pytest.raises(guard.TookTooLong), guard.time_limit(spark, 2):
        endless.collect()
    assert time.monotonic() - started < 30
    beside.join()
    assert other
    with guard.time_limit(spark, 60):
        assert spark.range(5).count() == 5
    with pytest.raises(guard.TookTooLong), guard.time_limit(spark, 0.2) as still_in_time:
        time.sleep(0.6)
        still_in_time()
        raise AssertionError("the time is over")
    with pytest.raises(ZeroDivisionError), guard.time_limit(spark, 60):
        1 / 0
    assert spark.range(5).count() == 5


def test_refused_and_slow_queries_are_told_to_the_writer(spark):
    columns = ", ".join(f"CAST({'3' if c == 'commit_count' else '1' if c in ask.SCORES else chr(39) + 'x' + chr(39)} AS {'DOUBLE' if c in ask.SCORES[:2] else 'BIGINT' if c in ('commit_count', 'lines_modified') else 'TIMESTAMP' if c.endswith('_commit') else 'STRING'}) AS {c}" for c in ANSWER_INPUT)
    columns = columns.replace("CAST('x' AS TIMESTAMP)", "TIMESTAMP '2024-01-01'").replace("CAST('x' AS BIGINT)", "CAST(1 AS BIGINT)")
    told: list = []

    def writer(question, history):
        told[:] = [a.message for a in history]
        return [
            "DROP VIEW x",
            f"SELECT {columns} FROM range(100000000000000) r JOIN range(5) n ON r.id % 7 = n.id - 20",
            f"SELECT {columns}",
        ][len(history)]

    answer = ask.answer_question(spark, "who", writer, seconds=8)
    assert answer.num_tries == 2 and [r["author_email"] for r in answer.rows] == ["x"]
    assert "was not run" in told[0] and "took too long" in told[1]
    with pytest.raises(RuntimeError, match="cancelled"):
        ask.answer_question(spark, "who", lambda q, h: f"SELECT {columns} FROM range(100000000000000) r JOIN range(5) n ON r.id % 7 = n.id - 20", 0, seconds=2)
