"""Questions over the final table: SQL in, ranked people and their repositories out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.functions import display
from commitlens.functions.times import as_text, display_date, now_text
from commitlens.operators.filters import without_marks
from commitlens.operators.ranking import best_first
from commitlens.plans.guard import NotAllowed, TookTooLong, checked, time_limit
from commitlens.plans.prompts import missing_columns_hint, not_allowed_hint, retry_hint, too_long_hint
from commitlens.schemas import ANSWER_INPUT, QUERY_LOG
from commitlens.session import written
from commitlens.sources.tables import to_rows

# People per answer, repeats after the first attempt, and the message for no rows.
MAX_PEOPLE = 100
MAX_REPEATS = 5
# Seconds a query of a question may take.
MAX_SECONDS = 600.0
NO_RESULTS = "No results found"

SCORES = ["technical_ability", "impact_to_project", "commit_count"]


class MissingColumns(ValueError):
    """A question's SQL does not return the columns an answer is made of."""


def open_table(contributions: DataFrame, drop_bots: bool = False, name: str = "contributions") -> DataFrame:
    """Make the final table available to SQL and keep it in memory as it is read."""
    table = without_marks(contributions, "author_email") if drop_bots else contributions
    table = table.persist()
    table.createOrReplaceTempView(name)
    return table


def close_table(table: DataFrame, name: str = "contributions") -> None:
    table.sparkSession.catalog.dropTempView(name)
    table.unpersist()


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """One SELECT over the registered tables; anything else is refused before it runs (``guard.checked``)."""
    return checked(spark, sql)


def check_columns(result: DataFrame) -> DataFrame:
    """``result`` itself if it has all columns of the contract; looks at the analysed plan only."""
    missing = [c for c in ANSWER_INPUT if c not in result.columns]
    if missing:
        raise MissingColumns(f"missing {missing}: a query has to return all of {ANSWER_INPUT}")
    return result


def _ranks() -> list[Column]:
    # Nine decimals: equal means must not be told apart by the order in which they were summed.
    return [F.round(s, 9) for s in SCORES]


@dataclass(frozen=True)
class Packaged:
    """The people of an answer, one row each, and their rows, however many, as a table."""

    people: DataFrame
    rows: DataFrame


# Orders a person's rows.
ROW_ORDER = ["repo", "author_name", "reason"]


def package(result: DataFrame, people: int = MAX_PEOPLE) -> Packaged:
    """The best ``people`` by mean scores, with totals over all their rows, and those rows.

    Ranking reads numbers only, which Spark aggregates by hashing; the texts are read for the people
    that are returned. ``rows`` has (author_email, repo, author_name, reason, detail) and is
    never gathered, so a person may have any number of rows; ``nested`` puts them into lists.
    """
    check_columns(result)
    totals = result.groupBy("author_email").agg(
        F.sum("commit_count").alias("commit_count"),
        F.avg("impact_to_project").alias("impact_to_project"),
        F.avg("technical_ability").alias("technical_ability"),
        F.sum("impact_to_project").alias("impact_sum"),
        F.sum("technical_ability").alias("ability_sum"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    # At most `people` rows, read by three plans.
    ranked = written(best_first(totals, _ranks(), "author_email", people), "ranked")
    detail = F.struct(
        F.col("commit_count"),
        F.col("impact_to_project"),
        F.col("technical_ability"),
        F.col("repo"),
        as_text(F.col("first_commit")).alias("first_commit"),
        as_text(F.col("last_commit")).alias("last_commit"),
        F.col("lines_modified"),
    )
    chosen = F.broadcast(ranked.select(F.col("author_email").alias("_email")))
    own = result.join(chosen, F.col("author_email").eqNullSafe(F.col("_email")), "left_semi")
    rows = own.select("author_email", *ROW_ORDER, detail.alias("detail"))
    texts = own.groupBy(F.col("author_email").alias("_email")).agg(
        *[F.min(c).alias(c) for c in ("author_name", "languages", "keywords")]
    )
    named = ranked.join(F.broadcast(texts), F.col("author_email").eqNullSafe(F.col("_email"))).drop("_email")
    return Packaged(named.orderBy(*[r.desc_nulls_last() for r in _ranks()], F.asc("author_email")), rows)


def nested(packaged: Packaged) -> DataFrame:
    """One row per person with the lists ``reason`` and ``repo``, the whole of a person's rows in one cell.

    For answers whose people have few rows each, which ``people.n_rows`` tells; others are read from
    ``packaged.rows``.
    """
    lists = (
        packaged.rows.groupBy(F.col("author_email").alias("_email"))
        .agg(F.array_sort(F.collect_list(F.struct(*ROW_ORDER, "detail"))).alias("_rows"))
        .select(
            "_email",
            F.filter(F.transform("_rows", lambda r: r["reason"]), lambda x: x.isNotNull()).alias("reason"),
            F.transform("_rows", lambda r: r["detail"]).alias("repo"),
        )
    )
    joined = packaged.people.drop("impact_sum", "ability_sum", "n_rows").join(
        lists, F.col("author_email").eqNullSafe(F.col("_email"))
    )
    return joined.drop("_email").orderBy(*[r.desc_nulls_last() for r in _ranks()], F.asc("author_email"))


@dataclass(frozen=True)
class Attempt:
    """A query that gave no answer, and what its writer is told about it."""

    sql: str | None
    message: str


@dataclass
class Answer:
    """The people of an answer, the SQL that gave them, what went wrong and how many repeats it took.

    ``packaged`` has the people's rows as a table.
    """

    rows: list[dict[str, Any]]
    sql: str | None
    error: str | None
    num_tries: int
    packaged: Packaged | None = None


NextSql = Callable[[str, list[Attempt]], str]


def answer_question(
    spark: SparkSession, question: str, next_sql: NextSql, repeats: int = MAX_REPEATS, seconds: float | None = MAX_SECONDS
) -> Answer:
    """Ask for SQL until a query gives rows, at most ``repeats`` times anew.

    A query that is no plain SELECT is not run, one that takes longer than ``seconds`` (None: no limit) is cancelled;
    both count as failed attempts, and the next one is told why.

    ``next_sql`` gets the question and every failed attempt so far with a message: the error, no
    results, or, for missing columns, the whole list of them. It may be a model (``prompts.sql_request`` is the text to
    send) or any function; if it fails itself that counts as an attempt. If the last attempt was
    merely empty the answer is empty and says so; if it failed its error is raised.
    """
    history: list[Attempt] = []
    while True:
        sql = None
        try:
            sql = next_sql(question, list(history))
            with time_limit(spark, seconds) as still_in_time:
                packaged = package(run_sql(spark, sql))
                still_in_time()
                # At most MAX_PEOPLE rows come to the driver.
                rows = to_rows(packaged.people.drop("impact_sum", "ability_sum"))
            if rows:
                return Answer(rows, sql, None, len(history), packaged)
            error, message = None, retry_hint(NO_RESULTS)
        except MissingColumns as missing:
            error, message = missing, missing_columns_hint(ANSWER_INPUT)
        except NotAllowed as refused:
            error, message = refused, not_allowed_hint(str(refused))
        except TookTooLong as slow:
            error, message = slow, too_long_hint(str(slow))
        except Exception as failed:
            error, message = failed, retry_hint(str(failed))
        if len(history) == repeats:
            if error is not None:
                raise RuntimeError(f"Error executing query: {error}") from error
            return Answer([], sql, NO_RESULTS, len(history))
        history.append(Attempt(sql, message))


def first_nonempty(spark: SparkSession, candidates: list[str], seconds: float | None = MAX_SECONDS) -> Answer:
    """Run candidate queries in order until one gives rows; at most ``MAX_REPEATS`` after the first."""
    if not candidates:
        raise ValueError("no candidate query")
    repeats = min(len(candidates) - 1, MAX_REPEATS)
    return answer_question(spark, "", lambda _, history: candidates[len(history)], repeats, seconds)


def log_row(
    spark: SparkSession, query: str, status: str, sql: str, count: int, error: str, tries: int, seconds: float
) -> DataFrame:
    """One row for the query log."""
    row = spark.createDataFrame(
        [(query, status, sql, count, error, tries, seconds)],
        "query string, status string, sql string, num_results bigint, error string, num_tries bigint, seconds double",
    )
    return row.withColumn("ts", now_text()).select(*QUERY_LOG.fieldNames())


def search(
    spark: SparkSession,
    query: str | None,
    candidates: list[str] | NextSql,
    log_path: str | None = None,
    seconds: float | None = MAX_SECONDS,
) -> list[dict]:
    """Answer a question with SQL from a list or from a writer; every question but a blank one is logged."""
    if not query or not query.strip():
        return []
    started = time.monotonic()

    def log(status: str, sql: str, count: int, error: str, tries: int) -> None:
        if log_path is not None:
            row = log_row(spark, query, status, sql, count, error, tries, time.monotonic() - started)
            row.write.mode("append").parquet(log_path)

    repeats = MAX_REPEATS if callable(candidates) else min(len(candidates) - 1, MAX_REPEATS)
    try:
        if callable(candidates):
            answer = answer_question(spark, query, candidates, seconds=seconds)
        else:
            answer = first_nonempty(spark, candidates, seconds)
    except Exception as error:
        log("Failed", "None", 0, str(error), repeats)
        raise
    if answer.error:
        log("Failed", answer.sql or "None", 0, answer.error, answer.num_tries)
    else:
        log("Success", answer.sql, len(answer.rows), "None", answer.num_tries)
    return answer.rows


def present(packaged: Packaged) -> DataFrame:
    """The people of an answer with everything a results page shows of them, one line each.

    Totals and means come from sums over all of a person's rows, whatever their number.
    """
    ability = display.mean_score(F.col("ability_sum"), F.col("n_rows"))
    impact = display.mean_score(F.col("impact_sum"), F.col("n_rows"))
    languages = display.sorted_languages(F.col("languages"))
    return packaged.people.select(
        "author_email",
        "author_name",
        display.emails(F.col("author_email")).alias("emails"),
        F.coalesce("commit_count", F.lit(0)).alias("total_commits"),
        ability.alias("mean_ability"),
        impact.alias("mean_impact"),
        display.ability_band(ability).alias("ability_band"),
        display.ability_band(impact).alias("impact_band"),
        display.bar_width(ability).alias("ability_width"),
        display.bar_width(impact).alias("impact_width"),
        languages.alias("languages"),
        F.transform(languages, display.language_color).alias("language_colors"),
        "n_rows",
    )


def present_rows(packaged: Packaged) -> DataFrame:
    """The rows of an answer's people with link and display dates."""
    r = F.col("detail")
    return packaged.rows.select(
        "author_email",
        "author_name",
        "reason",
        "repo",
        display.repo_link(F.col("repo")).alias("link"),
        *[r[c].alias(c) for c in ("commit_count", "impact_to_project", "technical_ability", "lines_modified")],
        display_date(r["first_commit"]).alias("first_commit"),
        display_date(r["last_commit"]).alias("last_commit"),
    )
