import datetime as dt

from pyspark.sql import functions as F

from commitlens import schemas
from commitlens.plans import stages
from commitlens.sources import catalogue, readme
from commitlens.sources.gitlog import END, START, parse_logs, with_remote
from commitlens.streaming.append import append_new

D = dt.datetime


def commit(spark, rows):
    """(owner, repo, email, name, hash, date, message, files, added)"""
    full = [
        (repo, "u", owner, sha, name, email, date, message, files, added, 1, added + 1)
        for owner, repo, email, name, sha, date, message, files, added in rows
    ]
    return spark.createDataFrame(full, schemas.COMMITS).repartition(3)


HISTORY = [
    ("o", "r", "a@x", "Ada", "h2", D(2024, 1, 2), "second\n", ["b", "a"], 60),
    ("o", "r", "a@x", "A. Lovelace", "h1", D(2024, 1, 1), "first\n", ["a"], 50),
    ("o", "r", "a@x", "Ada", "h3", None, None, None, 10),
    ("o", "r", "a@x", "Ada", "h4", D(2024, 1, 3), "third\n", [], 5),
    ("o", "r", None, "Ghost", "h5", D(2024, 1, 1), "boo\n", ["g"], 1),
    ("o", "r", "b@x", "Bo", "h6", D(2024, 1, 1), "m\n", ["c"], 500),
]


def test_contributors(spark):
    got = {r.author_email: r for r in stages.extract_contributors(commit(spark, HISTORY)).collect()}
    ada = got["a@x"]
    # The commit without date counts for nothing but its lines; the name is that of the first date.
    assert (ada.author_name, ada.commit_count, ada.lines_added, ada.lines_deleted, ada.lines_modified) == ("A. Lovelace", 3, 125, 4, 129)
    assert (ada.first_commit, ada.last_commit) == (D(2024, 1, 1), D(2024, 1, 3))
    assert set(got) == {"a@x", "b@x", None}


def test_contributor_rows_by_position(spark):
    c = commit(spark, HISTORY)
    messages = stages.contributor_messages(c).where("author_email = 'a@x'").orderBy("position").collect()
    assert [m.message for m in messages] == ["first\n", "second\n", "third\n"]
    files = stages.contributor_files(c).where("author_email = 'a@x'").orderBy("position").collect()
    assert [x for f in files for x in f.files_changed] == ["a", "b", "a"]


def test_scores(spark):
    c = commit(spark, HISTORY)
    seen = spark.sparkContext.accumulator(0)

    def client():
        def complete(request):
            seen.add(1)
            assert "first second third" in request and "Files: a, b\n" in request and "Commits: 3\n" in request
            return '{"impact_to_project": 7, "technical_ability": 8, "reason": "ok"}'

        return complete

    scored = stages.score_contributors(stages.extract_contributors(c), c, client).collect()
    assert [(r.author_email, r.impact_to_project, r.technical_ability, r.reason) for r in scored] == [("a@x", 7, 8, "ok")]
    assert seen.value == 1


def scored(spark, rows):
    """(owner, repo, email, name, commits, impact)"""
    full = [
        (o, r, e, n, c, 10, 1, 11, D(2024, 1, c), D(2024, 2, c), i, 5, f"{n} did") for o, r, e, n, c, i in rows
    ]
    return spark.createDataFrame(full, schemas.SCORED_CONTRIBUTORS).repartition(3)


def repos(spark, rows):
    return spark.createDataFrame(rows, "owner string, name string, languages array<string>, keywords array<string>, readme string")


def test_merge(spark):
    people = scored(
        spark,
        [
            ("o", "r1", "a@x", "Ada L.", 1, 4),
            ("o", "r1", "b@x", "ada l", 3, 8),
            ("o", "r2", "b@x", "Countess", 2, None),
            ("o", "gone", "c@x", "Solo", 2, 9),
            ("o", "r1", None, "Nobody", 1, 1),
        ]
        + [("o", "r2", f"bot{i}@x", "Bot", 1, 1) for i in range(16)],
    )
    projects = repos(
        spark,
        [
            ("o", "r1", ["Rust", "C"], ["K 1"], ""),
            ("o", "r1", ["Rust"], None, ""),
            ("o", "r2", [], ["k  1", "z"], ""),
        ],
    )
    got = {(r.author_name, r.repo): r for r in stages.merge_contributors(people, projects).collect()}
    assert set(got) == {("ada l", "o/r1"), ("countess", "o/r2"), ("solo", "o/gone"), ("nobody", "o/r1")}
    ada = got["ada l", "o/r1"]
    assert (ada.author_email, ada.email_count, ada.commit_count, ada.impact_to_project) == ("a@x|b@x", 2, 4, (4 + 24) / 4)
    assert ada.reason == "o/r1: Ada L. did\no/r1: ada l did"
    assert (ada.first_commit, ada.last_commit) == (D(2024, 1, 1), D(2024, 2, 3))
    countess = got["countess", "o/r2"]
    # One person: same identity, same tags, no stray delimiter for the empty list, no doubles.
    assert countess.author_email == "a@x|b@x" and countess.impact_to_project is None
    assert (ada.languages, ada.keywords) == (countess.languages, countess.keywords) == ("c|rust", "k 1|z")
    assert (got["solo", "o/gone"].languages, got["solo", "o/gone"].email_count) == (None, 1)
    assert (got["nobody", "o/r1"].author_email, got["nobody", "o/r1"].email_count) == (None, 0)
    assert stages.merge_contributors(people, projects).schema.names == schemas.CONTRIBUTIONS.names


def test_null_scores_in_means(spark):
    people = scored(spark, [("o", "r", "a@x", "Ada", 2, None), ("o", "r", "b@x", "ada", 2, 6)])
    projects = repos(spark, [("o", "r", ["c"], ["k"], "")])
    assert stages.merge_contributors(people, projects).first().impact_to_project == 3.0
    assert stages.merge_contributors(people, projects, skip_null_weights=True).first().impact_to_project == 6.0


def test_empty_address_joins_unless_ignored(spark):
    people = scored(spark, [("o", "r", "", "Ada", 1, 1), ("o", "r", "a@x", "ada", 1, 1), ("o", "r", "", "Bo", 1, 1), ("o", "s", "b@x", "Bo", 1, 1), ("o", "s", "", "bo", 1, 1)])
    projects = repos(spark, [("o", "r", ["c"], ["k"], "")])
    joined = {r.author_email for r in stages.merge_contributors(people, projects).collect()}
    assert joined == {"|a@x|b@x"}
    apart = {(r.author_name, r.author_email) for r in stages.merge_contributors(people, projects, ignore_emails=[""]).collect()}
    assert apart == {("ada", "a@x"), ("bo", None), ("bo", "b@x")}


CATALOGUE = [
    ("fast parser", "ann", "u1", "Parses JSON", 5),
    ("parser", "bob", "u2", None, 5),
    ("json tool", "ann", "u3", "a tool", 9),
    ("c++ kit", "cy", "u4", "kit", None),
]


def search(spark, keywords, limit):
    rows = spark.createDataFrame(CATALOGUE, "name string, owner string, url string, description string, stars long")
    found = catalogue.search(rows, keywords, limit, keep_query=True)
    return sorted([(r.query, r.url) for r in found.collect()], key=repr)


def test_search(spark):
    assert search(spark, ["parser"], 1) == [("parser", "u1")]
    assert search(spark, ["parser"], None) == search(spark, ["parser"], 0) == [("parser", "u1"), ("parser", "u2")]
    assert search(spark, ["parser"], 9) == [("parser", "u1"), ("parser", "u2")]
    assert search(spark, ["json", "parser"], 5) == [("json", "u1"), ("json", "u3"), ("parser", "u1"), ("parser", "u2")]
    assert search(spark, ["owner:ANN json tool", "nothing", "", "c++"], 5) == [("", None), ("c++", "u4"), ("nothing", None), ("owner:ANN json tool", "u3")]
    rows = spark.createDataFrame([(*r, None, None) for r in CATALOGUE], "name string, owner string, url string, description string, stars long, updated string, created_at string")
    got = stages.search_repos(rows, "json,absent", 1).collect()
    tagged = spark.createDataFrame([("n", "o", "u1", "d", 1, ["Rust", "C"]), ("m", "o", "u2", "d", 2, None)], "name string, owner string, url string, description string, stars long, language array<string>")
    assert [r.url for r in catalogue.search(tagged, ["language:rust"], None).collect()] == ["u1"]
    ranked = catalogue.search(rows, ["json", "absent"], 5, keep_query=True).select("query", "rank", "url").collect()
    assert sorted(map(tuple, ranked), key=repr) == [("absent", None, None), ("json", 1, "u3"), ("json", 2, "u1")]
    hits = catalogue.search_hits(rows, ["json", "absent"], ["name"], [])
    assert {r["query"]: r.total for r in catalogue.hit_counts(hits, ["json", "absent"]).collect()} == {"json": 1, "absent": 0}
    assert sorted([r.url for r in got], key=str) == [None, "u3"] and got[0].__fields__ == schemas.REPOS.names


def test_readme(spark):
    files = [
        ("u1", "docs/README.md", b"docs"), ("u1", "README.rst", b"rst"), ("u1", "README.md", b"top\r\nline"),
        ("u2", "docs/README.md", b"only docs"), ("u3", "main.c", b"x"),
        ("u4", "README.md", b"\xff"), ("u4", "readme", b"fine"), ("u6", "README.md", b"denied"),
    ]
    files = spark.createDataFrame([(u, p, bytearray(c)) for u, p, c in files], schemas.REPO_FILES)
    names = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "c"), ("u4", "d"), ("u5", "e"), ("u6", "cdnjs"), ("u1", "a2"), ("u7", None)], "url string, name string")
    got = {r.name: r.readme for r in stages.attach_readme(names, files).collect()}
    assert got == {"a": "top\nline", "a2": "top\nline", "b": "only docs", "c": None, "d": None, "e": None}
    assert len(readme.CANDIDATES) == len(set(readme.CANDIDATES)) == 66


def test_extract_commits(spark):
    log = f"{START}\nh\nAda\na@x\n2024-03-01 10:00:00 +0000\nm\n{END}\n1\t2\tf\n"
    logs = spark.createDataFrame([("https://g/o/r.git", log), ("https://g/o/r.git", log.replace("\nh\n", "\ni\n")), ("git@g:o/chromium.git", log), ("https://g/o/unlisted", log), ("broken", log)], schemas.REPO_LOGS)
    listed = spark.createDataFrame([("https://g/o/r.git", "r"), ("https://g/o/r.git", "r"), ("git@g:o/chromium.git", "chromium"), ("broken", "broken")], "url string, name string")
    got = stages.extract_commits(listed, logs, tasks=2)
    assert {(r.repo_owner, r.repo_name, r.hash, r.lines_modified) for r in got.collect()} == {("o", "r", "h", 3), ("o", "r", "i", 3)}
    assert got.count() == 2 and got.schema.names == schemas.COMMITS.names


def test_append_new(spark, tmp_path):
    log = f"{START}\nh\nAda\na@x\n2024-03-01 10:00:00 +0000\nm\n{END}\n1\t2\tf\n"
    source, output, progress = (str(tmp_path / n) for n in ("logs", "commits", "progress"))
    stage = lambda df: parse_logs(with_remote(df))
    for sha, total in (("h", 1), ("i", 2), (None, 2)):
        if sha:
            spark.createDataFrame([("https://g/o/r", log.replace("\nh\n", f"\n{sha}\n"))], schemas.REPO_LOGS).write.mode("append").parquet(source)
        append_new(spark, source, schemas.REPO_LOGS, stage, output, progress)
        assert spark.read.parquet(output).count() == total


def test_analyze_repos(spark):
    def client():
        async def complete(request):
            assert "Description: None" in request and "# " not in request
            return '{"languages": ["rust", "c"], "keywords": ["web server", "a"]}' if "Title" in request else "no"

        return complete

    rows = spark.createDataFrame([("a", None, "# Title\n"), ("b", None, None)], "name string, description string, readme string")
    got = {r.name: (r.languages, r.keywords) for r in stages.analyze_repos(rows, client, stages.Calls(attempts=1)).collect()}
    assert got == {"a": (["c", "rust"], ["a", "web-server"]), "b": (None, None)}


def test_flow_from_logs_to_final_table(spark):
    """All stages one after another, each reading what the one before wrote."""
    body = "".join(
        f"{START}\nh{i}\nAda\na@x\n2024-03-0{i} 10:00:00 +0000\nm{i}\n\n{END}\n90\t2\tf{i}\n" for i in range(1, 4)
    )
    listed = spark.createDataFrame([("r", "o", "https://g/o/r.git", "d", 5, "", "")], schemas.REPOS)
    files = spark.createDataFrame([("https://g/o/r.git", "README.md", bytearray(b"# R"))], schemas.REPO_FILES)
    logs = spark.createDataFrame([("https://g/o/r.git", body)], schemas.REPO_LOGS)
    analyzed = stages.analyze_repos(stages.attach_readme(listed, files), lambda: lambda r: '{"languages": ["Rust"], "keywords": ["k"]}')
    commits = stages.extract_commits(listed, logs)
    people = stages.score_contributors(
        stages.extract_contributors(commits), commits, lambda: lambda r: '{"impact_to_project": 3, "technical_ability": 4, "reason": "why"}'
    )
    final = stages.merge_contributors(people, analyzed).withColumn("d", F.lit(1)).first()
    assert (final.author_name, final.author_email, final.commit_count, final.repo) == ("ada", "a@x", 3, "o/r")
    assert (final.languages, final.keywords, final.reason, final.impact_to_project) == ("rust", "k", "o/r: why", 3.0)
