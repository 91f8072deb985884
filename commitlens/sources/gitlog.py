"""Commit rows out of log text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.functions.text import remote_parts, sanitize_utf8, strip
from commitlens.functions.times import commit_date
from commitlens.session import written

# The lines that frame a commit. A log is made with
#   --pretty=format:---COMMIT START---%n%H%n%an%n%ae%n%ai%n%B%n---COMMIT END--- --date=iso --numstat
START = "---COMMIT START---"
END = "---COMMIT END---"

# From a START line over the first END line to the next START line or the end of the log.
# (?d): only \n ends a line.
_COMMIT = rf"(?msd)^{START}\n.*?^{END}$\n?.*?(?=^{START}$|\z)"
_END_LINE = rf"(?md)^{END}$\n?"
# A START line among the four header lines, or right after them, begins the commit anew.
_RESTART = rf"\A{START}\n(?:(?:[^\n]*\n){{0,4}}?{START}\n)*"


def read_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, log) for every file under ``path``, one row per file, invalid UTF-8 replaced.

    A file is one cell, up to 2 GB; ``read_log_files`` has no such limit.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", sanitize_utf8(F.col("content").cast("string")).alias("log"))


_RECORD = "path string, block long, n long, at_start boolean, closed boolean, alone boolean, before long, value string"


def _count_closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the records of every block of a file as they are read, and count the closed ones before each.

    Only the small columns are looked at; the text passes through as it is.
    """
    place, n, closed_before, last_closed = None, 0, 0, False
    for batch in batches:
        paths, blocks, ended = (batch.column(i).to_pylist() for i in range(3))
        empty = pc.equal(batch.column(3), "").to_pylist()
        number, start, closed, alone, before = [], [], [], [], []
        for path, block, is_closed, is_empty in zip(paths, blocks, ended, empty, strict=True):
            if (path, block) != place:
                place, n, closed_before, last_closed = (path, block), 0, 0, False
            # What stands before the START line a file begins with; any other empty record is between two of them.
            is_closed = is_closed or (is_empty and block == 0 and n == 0)
            number.append(n)
            closed.append(is_closed)
            start.append(block == 0 and n == 0)
            alone.append(is_closed and last_closed)
            before.append(closed_before)
            n, closed_before, last_closed = n + 1, closed_before + is_closed, is_closed
        columns = [*batch.columns[:2], pa.array(number, pa.int64()), pa.array(start, pa.bool_()), pa.array(closed, pa.bool_())]
        columns += [pa.array(alone, pa.bool_()), pa.array(before, pa.int64()), batch.column(3)]
        names = ["path", "block", "n", "at_start", "closed", "alone", "before", "value"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, log) for the log files under ``path``, one row per commit, files of any size.

    START lines serve as the record separator of Spark's text reader, which splits a large file over
    many tasks. A START line opens a commit only behind a record that is closed: one with an END line that
    ends a line, or the empty one before the START line a file begins with. Any other START line is quoted in a
    message or breaks off a header, and its record belongs to the one before. So the number of closed records before a
    record says which commit it belongs to: records are numbered within their block as they are
    read, blocks are added up by file, and the few records that are not a commit by themselves are put
    together. A commit that is never closed has no END line and is not emitted by ``parse_logs``.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", f"{START}\n")
    value = F.col("value")
    ended = value.rlike(rf"(?md)^{END}$") & F.endswith(value, F.lit("\n"))
    block = F.col("_metadata.file_block_start")
    records = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        block.alias("block"),
        ended.alias("closed"),
        value,
    )
    numbered = records.mapInArrow(_count_closed, _RECORD)
    per_block = numbered.groupBy("path", "block").agg(F.sum(F.col("closed").cast("long")).alias("closed"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(per_block.select("path", "block", F.coalesce(F.sum("closed").over(earlier), F.lit(0)).alias("offset")), "blocks")
    begun = F.concat(F.when(F.col("at_start"), "").otherwise(f"{START}\n"), "value")
    alone = numbered.where(F.col("alone")).select("path", begun.alias("log"))
    parts = numbered.where(~F.col("alone")).join(offsets, ["path", "block"])
    piece = F.struct("block", "n", "value", "at_start")
    joined = parts.groupBy("path", (F.col("offset") + F.col("before")).alias("commit")).agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), f"{START}\n")
    first = F.when(F.element_at("parts", 1)["at_start"], "").otherwise(f"{START}\n")
    put = joined.select("path", F.concat(first, text).alias("log"))
    return alone.unionByName(put).where(F.col("log") != "").select("path", sanitize_utf8(F.col("log")).alias("log"))


def _stat_lines(text: Column) -> Column:
    """Array of (added, deleted, path); ``-`` counts 0, lines of another form are left out."""
    def number(c: Column) -> Column:
        # Tested first: a failing cast raises and catches an error for every such line.
        return F.when(c == "-", F.lit(0).cast("bigint")).when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("bigint"))

    tabbed = F.filter(F.split(text, "\n"), lambda line: line.contains("\t"))
    parts = F.filter(F.transform(tabbed, lambda line: F.split(strip(line), "\t")), lambda p: F.size(p) >= 3)
    stats = F.transform(
        parts,
        lambda p: F.struct(number(p[0]).alias("added"), number(p[1]).alias("deleted"), p[2].alias("path")),
    )
    return F.filter(stats, lambda s: s["added"].isNotNull() & s["deleted"].isNotNull())


def _total(stats: str, field: str) -> Column:
    return F.aggregate(F.col(stats), F.lit(0).cast("bigint"), lambda acc, s: acc + s[field])


def parse_logs(logs: DataFrame, log: str = "log") -> DataFrame:
    """One row per commit of a log column; the other columns are kept.

    One narrow stage of built-in expressions: the log is cut into commits, each commit into its
    header, message and stat lines. A commit without an END line is not emitted; a message that
    holds an END line is cut there, and the commit still gets every stat line up to the next START.
    """
    others = [c for c in logs.columns if c != log]
    # Cut and filtered inside the array, so that no commit is taken apart twice.
    cut = F.transform(
        F.regexp_extract_all(F.col(log), F.lit(_COMMIT), F.lit(0)),
        lambda c: F.split(F.regexp_replace(c, _RESTART, ""), _END_LINE, 2),
    )
    commits = logs.select(*others, F.explode(F.filter(cut, lambda halves: halves[0] != "")).alias("_halves"))
    # Four header lines and the rest. Every line ends in \n, so the last piece is no line by itself.
    pieces = commits.select(
        *others, F.split(F.col("_halves")[0], "\n", 5).alias("_head"), _stat_lines(F.col("_halves")[1]).alias("_stats")
    )

    def header_line(i: int) -> Column:
        return F.when(F.size("_head") > i + 1, strip(F.get("_head", F.lit(i))))

    rest = F.get("_head", F.lit(4))
    return pieces.select(
        *others,
        header_line(0).alias("hash"),
        header_line(1).alias("author_name"),
        header_line(2).alias("author_email"),
        commit_date(header_line(3)).alias("date"),
        F.when(rest != "", rest.substr(F.lit(1), F.length(rest) - 1)).alias("message"),
        F.transform("_stats", lambda s: s["path"]).alias("files_changed"),
        _total("_stats", "added").alias("lines_added"),
        _total("_stats", "deleted").alias("lines_deleted"),
    ).withColumn("lines_modified", F.col("lines_added") + F.col("lines_deleted"))


def with_remote(df: DataFrame, url: str = "url", legacy: bool = False) -> DataFrame:
    """Add repo_owner and repo_name from the remote address; rows with a malformed one are dropped."""
    owner, name = remote_parts(F.col(url), legacy)
    return df.withColumns({"repo_owner": owner, "repo_name": name}).where("repo_name IS NOT NULL")
