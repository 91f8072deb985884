"""An inverted index over the catalogue: searches read the postings of their own terms."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.operators.ranking import top_n_per_key, unlimited
from commitlens.sources.catalogue import terms_of

# Folders the terms are dealt to by hash, and rows of a file.
BUCKETS = 256
ROWS_PER_FILE = 5_000_000


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Index:
    """The index below ``path`` and what it was made with."""

    spark: SparkSession
    path: str
    searched: tuple[str, ...] = ("name", "description")
    qualifiers: tuple[str, ...] = ("language", "owner")
    stored: tuple[str, ...] = ("name", "owner", "url", "stars")
    buckets: int = BUCKETS

    def add(self, catalogue: DataFrame) -> None:
        """Append the postings of ``catalogue``, at first or as new repositories come.

        A posting is a term, the repository's number and its ``stored`` columns, so an answer needs no other table. Postings
        go into the folder of their term's bucket; a bucket that a hot term makes large is split over
        several tasks and files, and inside a file equal terms stand together, so that a search skips the rest of it.
        """
        spark = self.spark
        known = [q for q in self.qualifiers if q in catalogue.columns]
        # Numbers are unique inside a build, builds by their name.
        rows = catalogue.withColumn("_doc", F.monotonically_increasing_id()).select(
            F.explode(terms_of(catalogue, list(self.searched), known)).alias("term"), F.col("_doc").alias("doc"), *self.stored
        )
        postings = rows.where("term <> ''").withColumns({"build": F.lit(uuid.uuid4().hex), "bucket": bucket_of(F.col("term"), self.buckets)})
        sorted_rows = postings.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "term")
        sorted_rows.write.mode("append").partitionBy("bucket").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(self.path)
        spark.catalog.refreshByPath(self.path)

    def postings(self, terms: list[str]) -> DataFrame:
        """The postings of some terms: their buckets' folders are read, of these the row groups that hold them."""
        lit = [F.lit(t) for t in terms]
        one_of = F.col("bucket").isin(*[bucket_of(t, self.buckets) for t in lit])
        return self.spark.read.parquet(self.path).where(one_of & F.col("term").isin(*lit)).drop("bucket")

    def hits(self, keywords: list[str]) -> DataFrame:
        """(query_id, query, doc, build, stored columns): one row per keyword and repository that has all its terms."""
        asked = []
        for i, keyword in enumerate(keywords):
            terms = sorted(set(keyword.lower().split()))
            asked += [(i, keyword, t, len(terms)) for t in terms]
        if not asked:
            empty = self.spark.read.parquet(self.path).limit(0).drop("bucket", "term")
            return empty.select(F.lit(0).alias("query_id"), F.lit("").alias("query"), "*")
        queries = self.spark.createDataFrame(asked, "query_id int, query string, term string, _terms int")
        # As long as the caller's own list of keywords.
        found = self.postings(sorted({a[2] for a in asked})).join(F.broadcast(queries), "term").drop("term")
        one = found.where("_terms = 1").drop("_terms")
        if all(a[3] == 1 for a in asked):
            return one.select("query_id", "query", "doc", "build", *self.stored)
        # A repository has each of a keyword's terms at most once, so it has them all if it comes as often.
        key = ["query_id", "query", "build", "doc"]
        several = found.where("_terms > 1").groupBy(*key, "_terms").agg(
            F.count(F.lit(1)).alias("_found"), *[F.first(c).alias(c) for c in self.stored]
        )
        both = several.where("_found = _terms").select(*one.columns)
        return one.unionByName(both).select("query_id", "query", "doc", "build", *self.stored)

    def search(
        self,
        keywords: list[str],
        limit: int | None = None,
        stars: str = "stars",
        tie_break: tuple[str, ...] = ("owner", "name", "url"),
    ) -> DataFrame:
        """What ``catalogue.search`` gives with ``keep_query``: query_id, query, rank (given a limit) and the stored columns."""
        order = [F.desc_nulls_last(stars), *[F.asc(c) for c in tie_break]]
        found = self.hits(keywords).drop("doc", "build")
        if not unlimited(limit):
            found = top_n_per_key(found, ["query_id"], order, int(limit))
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
        asked = self.spark.createDataFrame(list(enumerate(keywords)), "query_id int, query string")
        # One row per keyword on the small side; a keyword without hits keeps a row of nulls.
        out = F.broadcast(asked).join(found.drop("query"), "query_id", "left")
        return out if not unlimited(limit) else out.orderBy("query_id", *order)

    def counts(self, keywords: list[str]) -> DataFrame:
        """(query_id, query, total): all hits per keyword; 0 for a keyword without any."""
        asked = self.spark.createDataFrame(list(enumerate(keywords)), "query_id int, query string")
        counted = self.hits(keywords).groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
        return asked.join(counted, "query_id", "left").fillna(0, ["total"])
