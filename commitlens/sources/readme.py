"""The README among a repository's files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.functions.text import text_from_bytes
from commitlens.operators.joins import lookup_join

# Where a README may be, best place first.
CANDIDATES = [
    "README.md",
    "readme.md",
    "Readme.md",
    "README.markdown",
    "README",
    "README.txt",
    "ReadMe.md",
    "readme",
    "readme.txt",
    "docs/README.md",
    "doc/README.md",
    "README.rst",
    "readme.rst",
    "README.adoc",
    "Readme",
    "ReadMe",
    "Readme.txt",
    "ReadMe.txt",
    "README.MD",
    "readme.MD",
    "READ_ME.md",
    "read_me.md",
    "READ_ME",
    "read_me",
    "READ_ME.txt",
    "read_me.txt",
    "documentation/README.md",
    "docs/readme.md",
    "doc/readme.md",
    "documentation/readme.md",
    "docs/index.md",
    "doc/index.md",
    "documentation/index.md",
    "readme.markdown",
    "Readme.markdown",
    "README.html",
    "readme.html",
    "Readme.html",
    "ReadMe.html",
    "README.rdoc",
    "readme.rdoc",
    "README.pod",
    "readme.pod",
    "README.org",
    "readme.org",
    "README.asciidoc",
    "readme.adoc",
    "Readme.adoc",
    "ReadMe.adoc",
    "README.tex",
    "readme.tex",
    "Readme.MD",
    "ReadMe.MD",
    "README.TXT",
    "readme.TXT",
    "Readme.TXT",
    "ReadMe.TXT",
    "README.RST",
    "readme.RST",
    "Readme.RST",
    "README.ADOC",
    "readme.ADOC",
    "Readme.ADOC",
    "README.HTML",
    "readme.HTML",
    "Readme.HTML",
]


def pick_readme(files: DataFrame, repo: str = "url", path: str = "path", content: str = "content") -> DataFrame:
    """(repo, readme) per repository that has a candidate: the best-placed file as text.

    The best file decides even if it is not valid text: the README is then null. The list of paths
    is a plain IN filter, so it reaches the file scan; a minimum needs one value per group.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in CANDIDATES]), F.col(path))
    best = (
        files.where(F.col(path).isin(CANDIDATES))
        .groupBy(repo)
        .agg(F.min(F.struct(place.alias("place"), F.col(content).alias("content"))).alias("best"))
    )
    return best.select(repo, text_from_bytes(F.col("best.content")).alias("readme"))


def with_readme(repos: DataFrame, files: DataFrame, repo: str = "url") -> DataFrame:
    """Every repository, with its README or null."""
    return lookup_join(repos, pick_readme(files, repo), [repo], "left")
