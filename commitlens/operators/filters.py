"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.functions.lists import pipe_member

# Repositories too big to fetch, per stage.
NO_README = ["chromium", "cdnjs", "leetcode"]
NO_COMMITS = ["chromium", "cdnjs", "leetcode", "aws-sdk-java", "languagetool"]

# Marks of an automated or hidden e-mail address.
BOT_MARKS = ["[bot]", "@github.com"]

# Fixed value: whose history is worth scoring.
ACTIVE = "lines_modified > 100 AND commit_count >= 3"

# Fixed value: people with more addresses than this are bots.
MAX_EMAILS = 15


def deny(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Drop rows whose ``column`` is in ``names`` or null."""
    return df.where(~F.col(column).isin(names))


def active(df: DataFrame) -> DataFrame:
    return df.where(ACTIVE)


def without_marks(df: DataFrame, column: str, marks: list[str] = BOT_MARKS) -> DataFrame:
    """Drop rows whose ``column`` contains one of the literal ``marks``."""
    for mark in marks:
        df = df.where(~F.col(column).contains(mark))
    return df


def in_dates(c: Column, since: str | None = None, until: str | None = None) -> Column:
    """Both ends included; the column is compared as it is, so the bounds reach the file scan."""
    condition = F.lit(True)
    if since is not None:
        condition = condition & (c >= F.lit(since).cast("date"))
    if until is not None:
        condition = condition & (c <= F.lit(until).cast("date"))
    return condition


def like_lower(c: Column, pattern: str) -> Column:
    return F.lower(c).like(pattern.lower())


def has_tag(c: Column, tag: str) -> Column:
    """Membership in a pipe-joined column; the words of a compound tag may be given with spaces."""
    return pipe_member(c, tag.replace(" ", "-"))


def nothing(df: DataFrame) -> DataFrame:
    """The same columns, no rows, no job."""
    return df.where(F.lit(False))
