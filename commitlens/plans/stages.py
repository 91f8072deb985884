"""The batch stages, each a function from tables to a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens import schemas
from commitlens.functions.answers import QUALITY_BOUNDS, parse_answer
from commitlens.functions.lists import hyphenate, normalize_items, pipe_join
from commitlens.functions.text import data_uri, fill, normalize, prefixed_reason, slug, to_plain
from commitlens.operators import aggregates, identity, ledger
from commitlens.operators.filters import MAX_EMAILS, NO_COMMITS, NO_README, active, deny
from commitlens.operators.infer import Calls, answer_check, ask_model, in_tasks
from commitlens.operators.joins import lookup_join
from commitlens.operators.ranking import unlimited
from commitlens.session import written
from commitlens.plans import prompts
from commitlens.sources import catalogue as catalogue_search
from commitlens.sources.gitlog import parse_logs, with_remote
from commitlens.sources.readme import with_readme

CONTRIBUTOR = ["repo_owner", "repo_name", "author_email"]
LINE_COUNTS = ["lines_added", "lines_deleted", "lines_modified"]
# Commits of a contributor are put in this order wherever order matters.
COMMIT_ORDER = ["date", "hash"]


def search_repos(
    catalogue: DataFrame,
    keywords: list[str] | str = "language:rust",
    limit: int | None = 10,
    qualifiers: tuple[str, ...] = ("language", "owner"),
) -> DataFrame:
    """Repositories per keyword, those with the most stars; ``owner:ann`` asks for a qualifier column."""
    if isinstance(keywords, str):
        keywords = catalogue_search.parse_keywords(keywords)
    return catalogue_search.search(catalogue, keywords, limit, qualifiers=qualifiers).select(*schemas.REPOS.fieldNames())


def attach_readme(repos: DataFrame, files: DataFrame) -> DataFrame:
    """Repositories that can be fetched, with their README or null."""
    return with_readme(deny(repos, "name", NO_README), files)


def _asked(
    df: DataFrame, request: Column, make_client: Callable, calls: Calls, accept: Callable, tasks: int | None, kept: str | None
) -> DataFrame:
    """``df`` with the model's ``_text``; answers come from and go to the ledger ``kept``, if there is one."""
    # A column of its own, which the always true test keeps Spark from moving: it does not take a Python function
    # out of a projection if the function's argument is an expression with nested lambda functions.
    apart = F.when(F.monotonically_increasing_id() >= 0, request)
    if kept is not None:
        asked = df.withColumn("_request", apart)
        return ledger.with_answers(asked, F.col("_request"), kept, make_client, calls, accept, tasks=tasks).drop("_request")
    asked = in_tasks(df, tasks).withColumn("_request", apart)
    return asked.withColumn("_text", ask_model(F.col("_request"), make_client, calls, accept)).drop("_request")


def analyze_repos(
    repos: DataFrame, make_client: Callable, calls: Calls = Calls(), tasks: int | None = None, kept: str | None = None
) -> DataFrame:
    """Add languages and keywords as a model names them; null where it gives no valid answer.

    ``kept`` is the folder of a ledger of answers: requests it has an answer for are not sent again.
    """
    request = fill(
        prompts.PROJECT,
        name=F.col("name"),
        description=F.col("description"),
        readme=to_plain(F.col("readme")),
        languages_and_keywords_shape=F.lit(prompts.PROJECT_SHAPE),
    )
    asked = _asked(repos, request, make_client, calls, answer_check(schemas.PROJECT_ANALYSIS), tasks, kept)
    answered = asked.withColumn("_answer", parse_answer(F.col("_text"), schemas.PROJECT_ANALYSIS))
    return answered.withColumns(
        {
            "languages": F.array_sort("_answer.languages"),
            "keywords": hyphenate(F.col("_answer.keywords")),
        }
    ).drop("_text", "_answer")


def extract_commits(repos: DataFrame, logs: DataFrame, tasks: int | None = None, legacy: bool = False) -> DataFrame:
    """Commits of the repositories that can be fetched, out of (url, log) rows."""
    wanted = deny(repos, "name", NO_COMMITS).select("url").distinct()
    # Addresses first: the texts of logs that are not asked for are not moved to be dropped.
    kept = lookup_join(logs, wanted, ["url"])
    return parse_logs(with_remote(in_tasks(kept, tasks), legacy=legacy)).select(*schemas.COMMITS.fieldNames())


def extract_contributors(commits: DataFrame) -> DataFrame:
    """One row per repository and e-mail address: how much, since when, until when.

    The texts and file lists of a contributor, which may be any size, are separate tables:
    ``contributor_messages`` and ``contributor_files``.
    """
    return contributors_of(commits_by_name(commits))


def commits_by_name(commits: DataFrame) -> DataFrame:
    """Counts, sums and dates per contributor and name they signed with: what ``contributors_of`` needs, and mergeable.

    Numbers and dates are all that is aggregated over the commits, which Spark does by hashing.
    Picking a name, a string, would make it sort them.
    """
    return commits.groupBy(*CONTRIBUTOR, "author_name").agg(
        F.count("date").alias("commit_count"),
        *[F.sum(c).alias(c) for c in LINE_COUNTS],
        F.min("date").alias("first_commit"),
        F.max("date").alias("last_commit"),
    )


def contributors_of(by_name: DataFrame) -> DataFrame:
    """One row per contributor out of ``commits_by_name``, with the name they signed with first."""
    return by_name.groupBy(*CONTRIBUTOR).agg(
        aggregates.any_value_by("author_name", "first_commit", "author_name").alias("author_name"),
        F.sum("commit_count").alias("commit_count"),
        *[F.sum(c).alias(c) for c in LINE_COUNTS],
        F.min("first_commit").alias("first_commit"),
        F.max("last_commit").alias("last_commit"),
    )


def contributor_messages(commits: DataFrame) -> DataFrame:
    """All messages of every contributor: (contributor, position, message), by position one text."""
    rows = commits.select(*CONTRIBUTOR, *COMMIT_ORDER, "message").where("message IS NOT NULL")
    return aggregates.ordered_rows(rows, CONTRIBUTOR, COMMIT_ORDER).drop(*COMMIT_ORDER)


def contributor_files(commits: DataFrame) -> DataFrame:
    """All file lists of every contributor: (contributor, position, files_changed), by position one list."""
    rows = commits.select(*CONTRIBUTOR, *COMMIT_ORDER, "files_changed").where("files_changed IS NOT NULL")
    return aggregates.ordered_rows(rows, CONTRIBUTOR, COMMIT_ORDER).drop(*COMMIT_ORDER)


def contributor_requests(contributors: DataFrame, commits: DataFrame, top: int | None = None) -> DataFrame:
    """The active contributors with their ``request``: counts, first files and first words of their messages.

    ``top`` takes those with the most commits, then the most modified lines, then by name of repository and address.
    """
    order = [F.desc("commit_count"), F.desc("lines_modified"), *[F.asc_nulls_first(c) for c in CONTRIBUTOR]]
    worth = active(contributors) if unlimited(top) else active(contributors).orderBy(*order).limit(int(top))
    chosen = written(worth.withColumn("_who", identity.exact_key(CONTRIBUTOR)), "chosen")
    history = commits.select(
        identity.exact_key(CONTRIBUTOR).alias("_who"), *COMMIT_ORDER, "message", "files_changed"
    )
    # The others' texts are of no use.
    history = history.join(chosen.select("_who"), "_who", "left_semi")
    messages = aggregates.history_digest(history, ["_who"], "message", COMMIT_ORDER)
    files = aggregates.first_items(history, ["_who"], "files_changed")
    # One row per contributor on every side.
    joined = chosen.join(messages, "_who", "left").join(files, "_who", "left").drop("_who")
    request = fill(
        prompts.QUALITY,
        repo=F.col("repo_name"),
        commits=F.col("commit_count"),
        added=F.col("lines_added"),
        deleted=F.col("lines_deleted"),
        modified=F.col("lines_modified"),
        files=F.coalesce(F.array_join("files_changed", ", "), F.lit("")),
        message=F.coalesce("message", F.lit("")),
        quality_shape=F.lit(prompts.QUALITY_SHAPE),
    )
    return joined.withColumn("request", request).drop("message", "files_changed")


def score_contributors(
    contributors: DataFrame,
    commits: DataFrame,
    make_client: Callable,
    calls: Calls = Calls(attempts=3, first_wait=0.0, longest_wait=0.0),
    top: int | None = None,
    tasks: int | None = None,
    kept: str | None = None,
) -> DataFrame:
    """The active contributors with a model's scores and reason; null where it gives no valid answer.

    ``top`` scores that many of them only; ``Calls(on_error="fail")`` stops at the first failure; ``kept`` is the
    folder of a ledger of answers.
    """
    check = answer_check(schemas.COMMIT_QUALITY, QUALITY_BOUNDS)
    requests = contributor_requests(contributors, commits, top)
    asked = _asked(requests, F.col("request"), make_client, calls, check, tasks, kept)
    answered = asked.withColumn("_answer", parse_answer(F.col("_text"), schemas.COMMIT_QUALITY, QUALITY_BOUNDS))
    return answered.select(*schemas.CONTRIBUTORS.fieldNames(), "_answer.*")


def _person_rows(
    contributors: DataFrame, max_emails: int, ignore_emails: list[str] | None, skip_null_weights: bool
) -> DataFrame:
    """One row per repository and normalised name, keyed by the person's joined e-mail addresses."""
    group = ["repo_owner", "repo_name", "author_name"]
    named = contributors.select(*schemas.SCORED_CONTRIBUTORS.fieldNames()).withColumns(
        {
            "author_name": normalize(F.col("author_name"), remove_punct=True, lowercase=True, white_space=True),
            "reason": prefixed_reason("repo_owner", "repo_name", "reason"),
        }
    )
    row_side, key_side = identity.resolve_identities(named, group, "author_email", ignore_emails)
    people = identity.canonical_identities(key_side, "author_email", max_emails)
    # key_count: -1 for too many addresses, null for groups without any, which are not in the graph.
    counted = lookup_join(row_side, people, ["component"], "left").select(
        F.col("row").alias("_group"), "identity", F.coalesce("key_count", F.lit(-1)).alias("key_count")
    )
    keyed = named.withColumn("_group", identity.exact_key(group))
    kept = lookup_join(keyed, counted, ["_group"], "left").where("key_count IS NULL OR key_count >= 0")
    reasons = F.array_sort(F.collect_list(F.struct("author_email", "reason")))
    return (
        kept.groupBy(*group, "identity", F.coalesce("key_count", F.lit(0)).alias("email_count"))
        .agg(
            F.sum("commit_count").alias("commit_count"),
            *[F.sum(c).alias(c) for c in LINE_COUNTS],
            F.min("first_commit").alias("first_commit"),
            F.max("last_commit").alias("last_commit"),
            # At most one row per address and no more than max_emails addresses are left.
            F.array_join(F.transform(reasons, lambda r: r["reason"]), "\n").alias("reason"),
            *[
                aggregates.weighted_mean(score, "commit_count", skip_null_weights).cast("double").alias(score)
                for score in ("impact_to_project", "technical_ability")
            ],
        )
        .withColumnRenamed("identity", "author_email")
    )


def _tags(column: str, kind: str, legacy: bool):
    return F.transform(
        normalize_items(F.col(column), legacy), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("tag"))
    )


def person_tags(people: DataFrame, repos: DataFrame, legacy: bool = False) -> DataFrame:
    """(author_email, languages, keywords): what the repositories a person worked on are tagged with."""
    # Repositories may be listed several times; items become distinct before any list is built.
    tags = (
        repos.select(
            "owner", "name", F.explode(F.concat(
                F.coalesce(_tags("languages", "language", legacy), F.array()),
                F.coalesce(_tags("keywords", "keyword", legacy), F.array()),
            )).alias("t")
        )
        .distinct()
        .groupBy("owner", "name")
        .agg(F.collect_list("t").alias("tags"))
    )
    worked_on = people.select("author_email", "repo_owner", "repo_name").distinct()
    tagged = lookup_join(worked_on, tags, [("repo_owner", "owner"), ("repo_name", "name")])
    distinct = tagged.select("author_email", F.explode("tags").alias("t")).distinct()

    def joined(kind: str):
        return pipe_join(F.array_sort(F.collect_list(F.when(F.col("t.kind") == kind, F.col("t.tag")))))

    return distinct.groupBy("author_email").agg(
        joined("language").alias("languages"), joined("keyword").alias("keywords")
    )


def merge_contributors(
    contributors: DataFrame,
    repos: DataFrame,
    max_emails: int = MAX_EMAILS,
    ignore_emails: list[str] | None = None,
    skip_null_weights: bool = False,
    legacy: bool = False,
) -> DataFrame:
    """The final table: scored contributors with their resolved identities and their projects' tags.

    One row per repository and normalised name. People whose repositories are unknown stay, with
    null tags; people with more than ``max_emails`` addresses are left out as bots.
    """
    # Written because it is read twice: for the tags and to be joined with them.
    people = written(_person_rows(contributors, max_emails, ignore_emails, skip_null_weights), "people")
    tags = person_tags(people, repos, legacy)
    return (
        lookup_join(people, tags, ["author_email"], "left")
        .withColumn("repo", slug("repo_owner", "repo_name"))
        .withColumn("email_count", F.col("email_count").cast("int"))
        .select(*schemas.CONTRIBUTIONS.fieldNames())
    )


def score_images(
    pictures: DataFrame,
    make_client: Callable,
    picture: str = "profile_pic",
    calls: Calls = Calls(attempts=1, in_flight=64),
    tasks: int | None = None,
    kept: str | None = None,
) -> DataFrame:
    """Add profile_pic_score and profile_pic_reason; a picture that cannot be scored keeps its row.

    ``kept`` is the folder of a ledger of answers.
    """
    request = fill(prompts.PICTURE, picture=data_uri(F.col(picture)), picture_shape=F.lit(prompts.PICTURE_SHAPE))
    known = F.when(F.col(picture).isNotNull(), request)
    asked = _asked(pictures, known, make_client, calls, answer_check(schemas.PICTURE_SCORE), tasks, kept)
    answered = asked.withColumn("_answer", parse_answer(F.col("_text"), schemas.PICTURE_SCORE))
    return answered.withColumns(
        {"profile_pic_score": F.col("_answer.score"), "profile_pic_reason": F.col("_answer.reason")}
    ).drop("_text", "_answer")
