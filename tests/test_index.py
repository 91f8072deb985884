import glob

import pytest
from pyspark.sql import functions as F

from commitlens.sources import catalogue
from commitlens.sources.index import Index

ROWS = [(f"red n{i % 40}", f"o{i % 5}", f"u{i:03}", f"made of {'gear' if i % 3 else 'Ring,ring'}", i % 17, ["Rust", "Go"][: i % 3]) for i in range(200)]
SCHEMA = "name string, owner string, url string, description string, stars bigint, language array<string>"
KEYWORDS = ["red", "red gear", "gear red made", "owner:o1 n6", "language:rust language:go", "nosuch", "ring", "", "GEAR"]


@pytest.fixture
def rows_and_index(spark, tmp_path):
    df = spark.createDataFrame(ROWS + ROWS[:3], SCHEMA).repartition(3)
    made = Index(spark, str(tmp_path / "index"), buckets=16)
    made.add(df.where("stars < 9"))
    made.add(df.where("stars >= 9"))
    return df, made


def shown(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_answers_are_those_of_the_catalogue(rows_and_index):
    df, made = rows_and_index
    columns = ["query", "name", "owner", "url", "stars"]
    assert shown(made.search(KEYWORDS), *columns) == shown(catalogue.search(df, KEYWORDS, None, keep_query=True), *columns)
    assert shown(made.search(KEYWORDS, 7), "rank", *columns) == shown(catalogue.search(df, KEYWORDS, 7, keep_query=True), "rank", *columns)
    totals = catalogue.hit_counts(catalogue.search_hits(df, KEYWORDS, ["name", "description"], ["language", "owner"]), KEYWORDS)
    assert shown(made.counts(KEYWORDS), "query", "total") == shown(totals, "query", "total")
    assert shown(made.search([""]), *columns) == [("", None, None, None, None)]


def test_a_search_reads_its_terms_buckets_only(rows_and_index, spark):
    _, made = rows_and_index
    found = made.hits(["ring"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(term,ring)" in plan or "In(term" in plan
    files = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    every = glob.glob(f"{made.path}/bucket=*/*.parquet")
    assert 0 < len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1 < len({f.split("bucket=")[1].split("/")[0] for f in every})
    assert plan.count("Scan parquet") == 1


def test_a_hot_term_is_split(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.lit("hot").alias("name"), F.concat(F.lit("o"), "id").alias("owner"), F.concat(F.lit("u"), "id").alias("url"),
        F.lit(None).cast("string").alias("description"), F.col("id").alias("stars"), F.array().cast("array<string>").alias("language"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
    try:
        made = Index(spark, str(tmp_path / "index"), buckets=2)
        made.add(rows.repartition(8))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {r[0]: r[1] for r in made.postings(["hot"]).groupBy(F.input_file_name()).count().collect()}
    assert len(files) > 1 and max(files.values()) < 60_000 and sum(files.values()) == 60_000
    top = made.search(["hot"], 2).collect()
    assert [(r.rank, r.stars) for r in sorted(top, key=lambda r: r["rank"])] == [(1, 59_999), (2, 59_998)]
