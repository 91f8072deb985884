"""Column contracts between the stages."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
    "binary": BinaryType(),
    "array<string>": ArrayType(StringType()),
}


def _struct(ddl: str) -> StructType:
    """``a string, b bigint`` without a running session, which ``fromDDL`` would need."""
    out = StructType()
    for field in ddl.split(", "):
        name, kind = field.split(" ")
        out.add(name, _TYPES[kind])
    return out


_AUTHORSHIP = (
    "repo_owner string, repo_name string, author_email string, author_name string, commit_count bigint, "
    "lines_added bigint, lines_deleted bigint, lines_modified bigint, "
    "first_commit timestamp, last_commit timestamp"
)

REPOS = _struct(
    "name string, owner string, url string, description string, stars bigint, updated string, created_at string"
)
REPO_FILES = _struct("url string, path string, content binary")
REPOS_WITH_README = _struct(
    "name string, owner string, url string, description string, stars bigint, updated string, "
    "created_at string, readme string"
)
PROJECT_ANALYSIS = _struct("languages array<string>, keywords array<string>")
REPO_LOGS = _struct("url string, log string")
COMMITS = _struct(
    "repo_name string, url string, repo_owner string, hash string, author_name string, author_email string, "
    "date timestamp, message string, files_changed array<string>, lines_added bigint, lines_deleted bigint, "
    "lines_modified bigint"
)
CONTRIBUTORS = _struct(_AUTHORSHIP)
COMMIT_QUALITY = _struct("impact_to_project bigint, technical_ability bigint, reason string")
SCORED_CONTRIBUTORS = _struct(
    _AUTHORSHIP + ", impact_to_project bigint, technical_ability bigint, reason string"
)
CONTRIBUTIONS = _struct(
    "author_name string, author_email string, commit_count bigint, lines_added bigint, lines_deleted bigint, "
    "lines_modified bigint, first_commit timestamp, last_commit timestamp, reason string, "
    "impact_to_project double, technical_ability double, email_count int, languages string, keywords string, "
    "repo string"
)
QUERY_LOG = _struct(
    "ts string, query string, status string, sql string, num_results bigint, error string, num_tries bigint, "
    "seconds double"
)
PICTURE_SCORE = _struct("score double, reason string")

# The columns a question's SQL has to return, in this order.
ANSWER_INPUT = [
    "author_name",
    "author_email",
    "commit_count",
    "impact_to_project",
    "technical_ability",
    "languages",
    "keywords",
    "repo",
    "reason",
    "first_commit",
    "last_commit",
    "lines_modified",
]
