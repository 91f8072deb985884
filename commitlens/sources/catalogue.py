"""Keyword search over a table of repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.operators.ranking import top_n_per_key, unlimited
from commitlens.session import written


def parse_keywords(text: str) -> list[str]:
    """``a,b`` as given on a command line."""
    return text.split(",")


def terms_of(catalogue: DataFrame, searched: list[str], qualifiers: list[str]) -> Column:
    """The terms a row can be found by: its words, and ``column:value`` for the qualifiers."""
    kinds = dict(catalogue.dtypes)
    parts = [F.split(F.lower(F.concat_ws(" ", *searched)), r"[^\p{L}\p{N}+#.-]+")]
    for column in qualifiers:
        values = F.col(column) if kinds[column].startswith("array") else F.array(F.col(column).cast("string"))
        # The loop variable is bound here: the lambda is called at once.
        named = F.transform(F.array_compact(values), lambda v: F.concat(F.lit(f"{column}:"), F.lower(v)))  # noqa: B023
        parts.append(F.coalesce(named, F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*parts))


def search_hits(
    catalogue: DataFrame, keywords: list[str], searched: list[str], qualifiers: list[str]
) -> DataFrame:
    """catalogue columns + query_id, query: one row per keyword and repository that matches it.

    A keyword is one or more terms, all of which must match: a word of the ``searched`` columns or
    ``column:value`` for a qualifier column, which may be a list. Terms are looked up by equality on a keyword's first
    term; the catalogue is read once and not shuffled.
    """
    spark = catalogue.sparkSession
    queries = []
    for i, keyword in enumerate(keywords):
        terms = keyword.lower().split()
        if terms:
            queries.append((i, keyword, terms[0], terms[1:]))
    asked = spark.createDataFrame(queries, "query_id int, query string, _first string, _rest array<string>")
    # As long as the caller's own list of keywords, which is in driver memory already.
    firsts = F.array(*[F.lit(t) for t in sorted({q[2] for q in queries})]).cast("array<string>")
    found = catalogue.withColumn("_tokens", terms_of(catalogue, searched, qualifiers)).withColumn(
        "_first", F.explode(F.array_intersect("_tokens", firsts))
    )
    hits = found.join(F.broadcast(asked), "_first")
    return hits.where(F.forall("_rest", lambda t: F.array_contains("_tokens", t))).drop("_first", "_rest", "_tokens")


def search(
    catalogue: DataFrame,
    keywords: list[str],
    limit: int | None = None,
    searched: tuple[str, ...] = ("name", "description"),
    qualifiers: tuple[str, ...] = ("language", "owner"),
    stars: str = "stars",
    tie_break: tuple[str, ...] = ("owner", "name", "url"),
    keep_query: bool = False,
) -> DataFrame:
    """Per keyword the hits with the most stars, ``limit`` of them (None or 0: all).

    A repository that matches two keywords comes twice; a keyword without hits gives one all-null row.
    Qualifiers the catalogue has no column for are left out. With ``keep_query`` a row also has its keyword
    and, given a limit, its ``rank`` by stars; all hits come sorted by keyword and stars.
    """
    known = [q for q in qualifiers if q in catalogue.columns]
    hits = search_hits(catalogue, keywords, list(searched), known)
    order = [F.desc_nulls_last(stars), *[F.asc(c) for c in tie_break]]
    if not unlimited(limit):
        hits = top_n_per_key(hits, ["query_id"], order, int(limit))
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    # Written, so that the catalogue is read only once.
    hits = written(hits, "hits")
    answered = hits.select("query_id").distinct()
    asked = catalogue.sparkSession.createDataFrame(list(enumerate(keywords)), "query_id int, query string")
    # One row per keyword on either side of this join.
    without = asked.join(answered, "query_id", "left_anti")
    out = hits.unionByName(without, allowMissingColumns=True)
    if unlimited(limit):
        out = out.orderBy("query_id", *order)
    return out if keep_query else out.drop("query_id", "query", "rank")


def hit_counts(hits: DataFrame, keywords: list[str]) -> DataFrame:
    """(query_id, query, total): all hits per keyword, limit or not; 0 for a keyword without any."""
    asked = hits.sparkSession.createDataFrame(list(enumerate(keywords)), "query_id int, query string")
    counted = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    return asked.join(counted, "query_id", "left").fillna(0, ["total"])
