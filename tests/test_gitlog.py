import datetime as dt
import random

import pytest

from commitlens.sources.gitlog import END, START, parse_logs, read_log_files, read_logs, with_remote

UTC = dt.timezone.utc


def header(sha="h", name="Ada", email="ada@x", date="2024-03-01 10:00:00 +0530"):
    return f"{START}\n{sha}\n{name}\n{email}\n{date}\n"


def parsed(spark, *logs):
    df = spark.createDataFrame([(i, log) for i, log in enumerate(logs)], "id int, log string")
    return [r.asDict() for r in parse_logs(df).orderBy("id", "hash").collect()]


def test_sample(spark):
    log = (
        header("a1b2") + "Fix parser\n\nBody line\n\n" + f"{END}\n\n3\t1\tsrc/a.py\n-\t-\timg/logo.png\n"
        + header("c3d4", "Bo", "bo@x", "2024-03-02 08:00:00 +0000") + f"Merge\n\n{END}\n"
    )
    first, second = parsed(spark, log)
    assert (first["hash"], first["message"]) == ("a1b2", "Fix parser\n\nBody line\n")
    assert first["date"].replace(tzinfo=UTC) == dt.datetime(2024, 3, 1, 4, 30, tzinfo=UTC)
    assert (first["lines_added"], first["lines_deleted"], first["lines_modified"]) == (3, 1, 4)
    assert first["files_changed"] == ["src/a.py", "img/logo.png"]
    assert (second["message"], second["files_changed"], second["lines_modified"]) == ("Merge\n", [], 0)


@pytest.mark.parametrize(
    "log, expected",
    [
        ("", []),
        (f"{END}\n1\t1\tx\n", []),
        (f"{START}\n{END}\n", []),
        (header() + "cut log\n1\t2\tx\n", []),
        (f"{START}\n h \n N\t\n{END}\n1\t2\ta b\n", [("h", "N", None, None, None, ["a b"], 3)]),
        (header(date="yesterday") + f"m\n{END}\n", [("h", "Ada", "ada@x", None, "m", [], 0)]),
        (header() + f"{END}\n", [("h", "Ada", "ada@x", "d", None, [], 0)]),
        (header() + f"\n{END}\n", [("h", "Ada", "ada@x", "d", "", [], 0)]),
        (header() + f"m\n{START}\nquoted\n{END}\n", [("h", "Ada", "ada@x", "d", f"m\n{START}\nquoted", [], 0)]),
        (header() + f"m\n{END}\nrest\n{END}\n1\t2\tx\n", [("h", "Ada", "ada@x", "d", "m", ["x"], 3)]),
        (header() + f"m\n{END}\na\t1\tx\n1\t2\n1\t2\ty\tz\n", [("h", "Ada", "ada@x", "d", "m", ["y"], 3)]),
        (f"{START}\nold\nOld\n" + header() + f"m\n{END}\n", [("h", "Ada", "ada@x", "d", "m", [], 0)]),
        (header("old") + header() + f"m\n{END}\n", [("h", "Ada", "ada@x", "d", "m", [], 0)]),
        (header() + f" {START}\nx{END}\n{END}\n", [("h", "Ada", "ada@x", "d", f" {START}\nx{END}", [], 0)]),
    ],
)
def test_grammar(spark, log, expected):
    got = [
        (c["hash"], c["author_name"], c["author_email"], c["date"] and "d", c["message"], c["files_changed"], c["lines_modified"])
        for c in parsed(spark, log)
    ]
    assert got == expected


def restated(log):
    """The log's commits by a plain walk over its lines."""
    out, lines, i = [], log.split("\n"), 0
    while i < len(lines):
        if lines[i] != START:
            i += 1
            continue
        fields, i = [], i + 1
        while i < len(lines) and len(fields) < 4 and lines[i] not in (START, END):
            fields.append(lines[i].strip())
            i += 1
        message = None
        if i < len(lines) and lines[i] == START:
            continue
        if len(fields) == 4 and i < len(lines) and lines[i] != END:
            begin = i
            while i < len(lines) and lines[i] != END:
                i += 1
            message = "\n".join(lines[begin:i])
        if i >= len(lines):
            break
        added = deleted = 0
        files = []
        i += 1
        while i < len(lines) and lines[i] != START:
            parts = lines[i].strip().split("\t")
            i += 1
            if len(parts) < 3:
                continue
            try:
                a, d = (0 if p == "-" else int(p) for p in parts[:2])
            except ValueError:
                continue
            added, deleted, files = added + a, deleted + d, files + [parts[2]]
        if fields:
            fields += [None] * (4 - len(fields))
            out.append((*fields[:3], message, files, added, deleted))
    return out


def test_random_logs(spark):
    rng = random.Random(7)
    pieces = [START, END, START, END, "x", " y ", "", "1\t2\ta", "-\t-\tb c", "q\t1\tz", "2024-03-01 10:00:00 +0000", "3\t4\td\te"]
    logs = ["\n".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(1500)]
    expected = [(i, *c) for i, log in enumerate(logs) for c in restated(log)]
    df = parse_logs(spark.createDataFrame(list(enumerate(logs)), "id int, log string"))
    got = df.select("id", "hash", "author_name", "author_email", "message", "files_changed", "lines_added", "lines_deleted").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert len(expected) > 500


def test_remote_parts(spark):
    urls = ["https://h/o/r.git", "https://h/o/r", "git@h:o/r.git", "https://h/o/x.github.io.git", "nonsense", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {tuple(r) for r in with_remote(df).collect()} == {
        ("https://h/o/r.git", "o", "r"), ("https://h/o/r", "o", "r"), ("git@h:o/r.git", "o", "r"),
        ("https://h/o/x.github.io.git", "o", "x.github.io"),
    }
    legacy = {r.url: r.repo_name for r in with_remote(df, legacy=True).collect()}
    assert legacy["https://h/o/x.github.io.git"] == "xhub.io"


def test_read_logs(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.log").write_bytes(header().encode() + b"bad \xff byte\n" + END.encode() + b"\n")
    (tmp_path / "b.log").write_text(header("h2") + f"m\n{END}\n")
    got = {r.hash: r.message for r in parse_logs(read_logs(spark, str(tmp_path))).collect()}
    assert got == {"h": "bad � byte", "h2": "m"}


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "0")
    yield
    for n, value in zip(names, before):
        spark.conf.set(n, value)


def test_read_log_files(spark, tmp_path, tiny_splits):
    def block(i, message="m\n", marker=""):
        return header(f"h{i}") + f"{message}\n{END}\n{marker}\n{i}\t1\tfile {i}\n"

    plain = "".join(block(i, f"message {i}\n" * (i % 7)) for i in range(120))
    files = {
        "plain.log": plain,
        "quoted.log": block(1) + block(2, f"quotes\n{START}\nand goes on") + block(3),
        "midline.log": block(1) + block(2, f"says {START}\nmore") + block(3),
        "restart.log": f"{START}\nbroken\nheader\n" + block(1),
        "garbage.log": f"first\n{END}\n1\t1\tx\n" + block(1),
        "cut.log": block(1) + header("cut") + "message without end\n",
        "twice.log": block(1) + f"{END}\n5\t5\tmore\n" + block(2),
        "empty.log": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    logs = read_log_files(spark, str(tmp_path))
    assert spark.read.option("lineSep", f"{START}\n").text(str(tmp_path / "plain.log")).rdd.getNumPartitions() > 10
    columns = ["path", "hash", "message", "files_changed", "lines_added", "lines_deleted"]

    def rows(df):
        return sorted(repr((r.path.rsplit("/")[-1], *r[1:])) for r in parse_logs(df).select(*columns).collect())

    assert rows(logs) == rows(read_logs(spark, str(tmp_path)))
    assert logs.where("path LIKE '%plain.log'").count() == 120
    # A quoted line costs no more than its own commit: no file is read whole.
    assert logs.where("path LIKE '%quoted.log'").count() == 3


def test_random_log_files(spark, tmp_path, tiny_splits):
    rng = random.Random(11)
    pieces = [START, END, START, END, "x", " y ", "", "1\t2\ta", "q\t1\tz", f"says {START}", f"{END} it", "3\t4\td\te", "long " * 60]
    for i in range(60):
        lines = "\n".join(rng.choice(pieces) for _ in range(rng.randrange(90)))
        (tmp_path / f"{i}.log").write_text(lines + "\n" * rng.randrange(2))
    columns = ["path", "hash", "author_name", "message", "files_changed", "lines_added", "lines_deleted"]

    def rows(df):
        return sorted(repr((r.path.rsplit("/")[-1], *r[1:])) for r in parse_logs(df).select(*columns).collect())

    assert rows(read_log_files(spark, str(tmp_path))) == rows(read_logs(spark, str(tmp_path)))
