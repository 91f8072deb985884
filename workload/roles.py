"""The driver's tables seen as repositories, commits, logs and so on.

An order is a commit: its customer is the author, the customer's nation owns the repository, the
order priority names it, and the order's line items are the commit's changed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.plans.stages import extract_contributors
from commitlens.sources.gitlog import END, START

LANGUAGES = ["Rust", "Python", "C++", "Type  Script", "Go"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return customers.select(
        "c_custkey",
        F.col("n_name").alias("repo_owner"),
        F.col("c_name").alias("own_name"),
        # A name several customers of a nation share.
        F.concat(F.lit("Crew  "), "n_name", F.lit(" / "), F.floor(F.col("c_acctbal") / 100)).alias("crew_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "[bot]@ci.example.org")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "@github.com")
        .otherwise("@example.org")
        .alias("domain"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit rows, one per order; a customer has one address per order status."""
    stats = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("added"),
            F.sum(F.col("l_linenumber").cast("bigint")).alias("deleted"),
            F.array_sort(F.collect_list(F.concat(F.lit("p/"), "l_partkey"))).alias("files"),
        )
    )
    joined = (
        table(spark, sf_dir, "orders")
        .join(stats, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(_authors(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    )
    added, deleted = F.coalesce("added", F.lit(0)), F.coalesce("deleted", F.lit(0))
    return joined.select(
        F.col("o_orderpriority").alias("repo_name"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("https://git.example.org/"), "repo_owner", F.lit("/"), "o_orderpriority", F.lit(".git")))
        .otherwise(F.concat(F.lit("git@git.example.org:"), "repo_owner", F.lit("/"), "o_orderpriority", F.lit(".git")))
        .alias("url"),
        "repo_owner",
        F.col("o_orderkey").cast("string").alias("hash"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("crew_name")).otherwise(F.col("own_name")).alias("author_name"),
        F.concat(F.lit("c"), "c_custkey", F.lit("."), F.lower("o_orderstatus"), "domain").alias("author_email"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.concat(
            F.lit("Order "), "o_orderkey", F.lit("\n\nStatus "), "o_orderstatus", F.lit(" of customer "), "o_custkey", F.lit("\n")
        ).alias("message"),
        F.coalesce("files", F.array().cast("array<string>")).alias("files_changed"),
        added.alias("lines_added"),
        deleted.alias("lines_deleted"),
        (added + deleted).alias("lines_modified"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, log): per order a log of its commit and of a merge without files."""
    line_items = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.concat_ws("\t", F.col("l_quantity").cast("bigint"), "l_linenumber", F.concat(F.lit("p/"), "l_partkey"))
                )
            ).alias("stat_lines")
        )
    )
    c = commits(spark, sf_dir).join(line_items, F.col("hash") == F.col("l_orderkey").cast("string"), "left")
    when = F.date_format("date", "yyyy-MM-dd HH:mm:ss xx")

    def block(sha, message, stat_lines):
        return F.concat(
            F.lit(f"{START}\n"), sha, F.lit("\n"), "author_name", F.lit("\n "), "author_email", F.lit("\n"), when,
            F.lit("\n"), message, F.lit(f"\n{END}\n\n"), stat_lines,
        )

    stat_lines = F.concat(
        F.coalesce(F.array_join("stat_lines", "\n"), F.lit("")), F.lit("\n-\t-\timg/logo.png\nnot\ta\tnumber\n")
    )
    merge = F.lit(f"Merge\n{START}\nquoted\n")
    log = F.concat(
        block(F.col("hash"), F.col("message"), stat_lines), block(F.concat(F.lit("m"), "hash"), merge, F.lit(""))
    )
    return c.select("url", log.alias("log"))


def log_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remotes of the logs."""
    return commits(spark, sf_dir).select("url", F.col("repo_name").alias("name"))


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed repositories: one per nation and order priority, some listed twice, and not all of them."""
    seen = (
        table(spark, sf_dir, "orders")
        .join(_authors(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("repo_owner").alias("owner"), F.col("o_orderpriority").alias("name"), "o_orderstatus")
        .distinct()
        .where("name <> '3-MEDIUM'")
    )
    number = F.element_at(F.split("owner", "_"), -1).cast("int")
    languages = F.array(*[F.lit(x) for x in LANGUAGES])
    return seen.select(
        "name",
        "owner",
        F.concat(F.lit("https://git.example.org/"), "owner", F.lit("/"), "name", F.lit(".git")).alias("url"),
        F.lit("").alias("readme"),
        F.array(
            F.element_at(languages, F.pmod(number, F.lit(5)) + 1),
            F.element_at(languages, F.pmod(number + 2, F.lit(5)) + 1),
        ).alias("languages"),
        F.array(F.concat(F.lit("Topic-"), F.substring("name", 3, 20)), F.concat(F.lit("nation-"), number)).alias("keywords"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributors with scores that follow from their counts; some scores are missing."""
    impact = F.when(F.col("lines_modified") % 13 != 0, 1 + F.col("commit_count") % 10)
    ability = 1 + F.col("lines_modified") % 10
    return extract_contributors(commits(spark, sf_dir)).select(
        "*",
        impact.cast("bigint").alias("impact_to_project"),
        ability.cast("bigint").alias("technical_ability"),
        F.concat(F.lit("did "), "commit_count").alias("reason"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search catalogue: a part is a repository, its price the stars."""
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("owner"),
        F.concat(F.lit("https://git.example.org/part/"), "p_partkey").alias("url"),
        F.col("p_type").alias("description"),
        F.col("p_retailprice").cast("bigint").alias("stars"),
        F.lit(None).cast("string").alias("updated"),
        F.lit(None).cast("string").alias("created_at"),
        # A repository in one language or two.
        F.array_distinct(
            F.array(*[F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), F.pmod(F.col(c), F.lit(5)).cast("int") + 1) for c in ("p_partkey", "p_size")])
        ).alias("language"),
    )


# Where the n-th document of a repository lies.
PATHS = ["docs/README.md", "README.rst", "src/main.c", "readme", "README.md", "LICENSE", "README.txt"]


def repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, three to a repository; Spanish ones hold a byte that is not UTF-8."""
    text = F.encode(F.regexp_replace("text", "\n", "\r\n"), "UTF-8")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("repo"), F.floor(F.col("doc_id") / 3)).alias("url"),
        F.element_at(F.array(*[F.lit(p) for p in PATHS]), (F.pmod("doc_id", F.lit(7)) + 1).cast("int")).alias("path"),
        F.when(F.col("lang") == "es", F.concat(text, F.unhex(F.lit("FF")))).otherwise(text).alias("content"),
    )


def readme_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repositories the documents belong to, and one without files."""
    urls = table(spark, sf_dir, "documents").select(F.floor((F.col("doc_id") + 3) / 3).alias("n"))
    return urls.distinct().select(
        F.concat(F.lit("repo"), F.col("n")).alias("url"),
        F.when(F.col("n") == 5, "chromium").otherwise(F.concat(F.lit("name"), F.col("n"))).alias("name"),
    )
