import datetime as dt

import pytest

from commitlens import schemas
from commitlens.plans import ask, prompts
from commitlens.sources import tables

D = dt.datetime


def contributions(spark, rows):
    """(name, email, commits, impact, ability, repo)"""
    full = [
        (n, e, c, 1, 1, 2, D(2024, 1, 2), D(2024, 3, 4), f"{n} at {r}", i, a, 1, "rust|C++", "k", r)
        for n, e, c, i, a, r in rows
    ]
    return spark.createDataFrame(full, schemas.CONTRIBUTIONS)


@pytest.fixture
def people(spark):
    rows = [(f"p{i}", f"e{i:03}", 1, 1.0, 1.0, "o/r") for i in range(101)]
    rows += [("top", "top@x|t@x", 2, 4.0, 9.0, "o/a"), ("top", "top@x|t@x", 3, None, 8.0, "o/b"), ("none", "n", 99, None, None, "o/r")]
    table = ask.open_table(contributions(spark, rows))
    yield table
    ask.close_table(table)


def test_package(people):
    got = ask.nested(ask.package(people)).collect()
    assert len(got) == 100
    top = got[0]
    assert (top.author_email, top.commit_count, top.impact_to_project, top.technical_ability) == ("top@x|t@x", 5, 4.0, 8.5)
    assert top.reason == ["top at o/a", "top at o/b"]
    assert [(r.repo, r.commit_count, r.first_commit, r.lines_modified) for r in top.repo] == [
        ("o/a", 2, "2024-01-02 00:00:00", 2), ("o/b", 3, "2024-01-02 00:00:00", 2),
    ]
    # Ties on all scores go by address; the person without scores is last and falls off.
    assert [r.author_email for r in got[1:]] == [f"e{i:03}" for i in range(99)]


def test_a_person_with_many_rows_is_one_line(spark):
    rows = [("a", "a@x", 1 + i % 3, float(i % 7), 5.0, f"o/r{i}") for i in range(300)] + [("b", "b@x", 1, 4.0, 4.0, "o/r")]
    packaged = ask.package(contributions(spark, rows))
    shown = {r.author_email: r for r in ask.present(packaged).collect()}
    assert len(shown) == packaged.people.count() == 2
    mine = shown["a@x"]
    assert (mine.total_commits, mine.n_rows, mine.mean_ability) == (600, 300, 5.0)
    assert mine.mean_impact == round(sum(i % 7 for i in range(300)) / 300, 1)
    listed = [r.repo for r in ask.present_rows(packaged).collect() if r.author_email == "a@x"]
    assert sorted(listed) == sorted(f"o/r{i}" for i in range(300))


def test_null_identity_is_one_person(spark):
    got = ask.nested(ask.package(contributions(spark, [("a", None, 1, 1.0, 1.0, "o/r"), ("b", None, 2, 1.0, 1.0, "o/s")]))).collect()
    assert [(r.author_email, r.commit_count, len(r.repo)) for r in got] == [(None, 3, 2)]


def test_ranking_is_hashed_over_numbers(people, spark, tmp_path, monkeypatch):
    tables.write_table(people, str(tmp_path / "t"))
    seen = []
    monkeypatch.setattr(ask, "written", lambda df, name: seen.append(df) or df)
    ask.package(spark.read.parquet(str(tmp_path / "t")))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "SortAggregate" not in plan and "reason" not in plan and "languages" not in plan


def test_contract(spark, people):
    assert ask.check_columns(people) is people
    with pytest.raises(ask.MissingColumns, match="lines_modified"):
        ask.package(ask.run_sql(spark, "SELECT author_email FROM contributions"))


GOOD = "SELECT * FROM contributions WHERE lower(repo) LIKE 'o/a'"
EMPTY = "SELECT * FROM contributions WHERE repo = 'x'"
BROKEN = "SELECT nothing FROM contributions"


def test_first_nonempty(spark, people):
    answer = ask.first_nonempty(spark, [EMPTY, BROKEN, GOOD, EMPTY])
    assert (answer.sql, answer.error, answer.num_tries) == (GOOD, None, 2)
    assert answer.rows[0]["author_email"] == "top@x|t@x" and answer.rows[0]["n_rows"] == 1
    assert [r.repo for r in answer.packaged.rows.collect()] == ["o/a"]
    nothing = ask.first_nonempty(spark, [BROKEN, EMPTY])
    assert (nothing.rows, nothing.error, nothing.num_tries) == ([], ask.NO_RESULTS, 1)
    with pytest.raises(RuntimeError, match="Error executing query"):
        ask.first_nonempty(spark, [EMPTY, BROKEN])
    assert ask.first_nonempty(spark, [EMPTY] * 6 + [GOOD]).error == ask.NO_RESULTS


def test_a_writer_is_told_what_went_wrong(spark, people):
    told = []

    def writer(question, history):
        told.append([a.message for a in history])
        assert question == "who" and prompts.sql_request(question, history, schemas.ANSWER_INPUT).count("Tried:") == len(history)
        return [BROKEN, "SELECT repo FROM contributions", EMPTY, GOOD][len(history)]

    answer = ask.answer_question(spark, "who", writer)
    assert (answer.sql, answer.num_tries, answer.error) == (GOOD, 3, None)
    broken, missing, empty = told[-1]
    assert "nothing" in broken and "lines_modified" in missing and ask.NO_RESULTS in empty
    assert told[:3] == [[], [broken], [broken, missing]]

    def failing(question, history):
        raise ValueError("model is down")

    with pytest.raises(RuntimeError, match="model is down"):
        ask.answer_question(spark, "who", failing)
    never = ask.answer_question(spark, "who", lambda q, h: EMPTY)
    assert (never.rows, never.error, never.num_tries) == ([], ask.NO_RESULTS, ask.MAX_REPEATS)


def test_search_and_log(spark, people, tmp_path):
    path = str(tmp_path / "log")
    assert len(ask.search(spark, "who", [GOOD], path)) == 1
    assert ask.search(spark, "nobody", [EMPTY], path) == []
    assert ask.search(spark, None, [GOOD], path) == ask.search(spark, " ", [GOOD], path) == []
    with pytest.raises(RuntimeError):
        ask.search(spark, "broken", [EMPTY, BROKEN], path)
    logged = {r["query"]: r for r in tables.to_rows(tables.read_table(spark, path, schemas.QUERY_LOG))}
    assert {q: (r["status"], r["num_results"], r["num_tries"]) for q, r in logged.items()} == {
        "who": ("Success", 1, 0), "nobody": ("Failed", 0, 0), "broken": ("Failed", 0, 1),
    }
    assert logged["who"]["error"] == "None" and logged["broken"]["sql"] == "None" and logged["who"]["seconds"] > 0


def test_bots_can_be_dropped(spark):
    rows = [("a", "a@x", 1, 1.0, 1.0, "o/r"), ("b", "b[bot]@x", 1, 1.0, 1.0, "o/r"), ("c", "c@github.com|d@x", 1, 1.0, 1.0, "o/r")]
    table = ask.open_table(contributions(spark, rows), drop_bots=True)
    assert [r.author_email for r in ask.run_sql(spark, "SELECT * FROM contributions").collect()] == ["a@x"]
    ask.close_table(table)


def test_present(people):
    packaged = ask.package(people)
    top = ask.present(packaged).first()
    assert (top.emails, top.total_commits, top.mean_ability, top.mean_impact) == (["top@x", "t@x"], 5, 8.5, 2.0)
    assert (top.ability_band, top.impact_band, top.ability_width) == ("green", "gray", 85.0)
    assert top.languages == ["C++", "rust"]
    assert [tuple(c) for c in top.language_colors] == [("bg-[#00599C]", "text-white"), ("bg-[#DEA584]", "text-black")]
    row = ask.present_rows(packaged).where("repo = 'o/a'").first()
    assert (row.link, row.first_commit) == ("https://github.com/o/a", "1/2/2024")
