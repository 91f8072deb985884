"""Requests sent to a model, one template per stage, and the answers' shapes."""

PROJECT = """You describe software repositories.
From the details below name the two main programming languages of the repository, no more, and up to ten
keywords for the problem it solves, its features, tools and frameworks. Hyphenate compound keywords.

Name: {name}
Description: {description}
README: {readme}

Answer with JSON: {languages_and_keywords_shape}
"""
PROJECT_SHAPE = '{"languages": ["..."], "keywords": ["..."]}'

QUALITY = """You judge contributions to software repositories.
Give two whole numbers from 1 to 10. impact_to_project: 10 for the people a project rests on, 7 to 9 for owners
of major features, 4 to 6 for regular contributors, 1 to 3 for occasional ones. technical_ability: 10 for an
expert, 7 to 9 for very strong skills, 4 to 6 for competence, 1 to 3 for a beginner.
Justify them by concrete facts in at most four sentences.

Repository: {repo}
Commits: {commits}
Lines added: {added}, deleted: {deleted}, modified: {modified}
Files: {files}
Commit messages:
{message}

Answer with JSON: {quality_shape}
"""
QUALITY_SHAPE = '{"impact_to_project": 1, "technical_ability": 1, "reason": "..."}'

PICTURE = """Rate this profile picture from 0 to 10 and say briefly why. Drawn or unusual pictures rate high,
plain portraits low. Be critical.

{picture}

Answer with JSON: {picture_shape}
"""
PICTURE_SHAPE = '{"score": 0.0, "reason": "..."}'

QUESTION_SQL = """You write one SQL query over the table contributions, which has a row per person and repository:

author_email: string, lower case; a person's addresses, joined by |
author_name: string, lower case
email_count: int; how many addresses the person has
commit_count, lines_added, lines_deleted, lines_modified: int
first_commit, last_commit: timestamp
impact_to_project, technical_ability: float from 1 to 10
reason: string; why the two scores are what they are
languages, keywords: string; lower-case values joined by |, compound keywords with hyphens
repo: string, owner/name, case as written

Keep the query simple. Write dates as CAST('2024-01-01' AS DATE); use >= for since, <= for before, BETWEEN for a
range. Put lower() around author_name, author_email and repo when comparing them; LIKE on repo finds owners and
names; look for a value of a joined column by a pattern. Order by technical_ability, impact_to_project and
commit_count, descending, unless asked otherwise. Return, in this order: {columns}.
{failures}
Question: {question}
"""


def retry_hint(error: str) -> str:
    return f"That query gave no answer ({error}). Write a different one."


def missing_columns_hint(columns: list[str]) -> str:
    return f"All of these columns must be returned, in this order: {', '.join(columns)}."


def not_allowed_hint(reason: str) -> str:
    return f"That query was not run ({reason}). Write one SELECT over the table, without commands or joins of all pairs."


def too_long_hint(reason: str) -> str:
    return f"That query took too long ({reason}). Ask for fewer rows or join on equal values."


def sql_request(question: str, history: list, columns: list[str]) -> str:
    """The text that asks a model for SQL, with everything that failed so far."""
    failures = "".join(f"\nTried: {a.sql}\n{a.message}\n" for a in history)
    return QUESTION_SQL.format(columns=", ".join(columns), failures=failures, question=question)
