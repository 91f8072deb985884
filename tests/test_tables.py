import pytest

from commitlens import session
from commitlens.sources import tables


def test_modes_and_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    df = tables.inline_table(spark, {"a": [1, 2], "b": ["x", None]}, "a int, b string")
    first = tables.write_table(df, path)
    assert all(r.path.endswith(".parquet") for r in first.collect())
    more = tables.write_table(df, path)
    # A write's manifest has its own files, not those before it.
    assert tables.read_table(spark, path).count() == 4 and more.count() == first.count()
    assert not {r.path for r in more.collect()} & {r.path for r in first.collect()}
    assert tables.manifest(spark, path).count() == 2 * first.count()
    over = tables.write_table(df, path, "overwrite")
    assert sorted(over.collect()) == sorted(tables.manifest(spark, path).collect())
    assert sorted(r.a for r in tables.read_table(spark, path, df.schema).collect()) == [1, 2]
    with pytest.raises(ValueError):
        tables.write_table(df, path, "ignore")


def test_sized_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(5_000).selectExpr("id", "if(id % 10 = 0, 'a b', 'hot') AS folder").repartition(7)
    made = tables.file_rows(tables.write_table(rows, path, "append", 1_000, ["folder"])).collect()
    assert all(0 < r.rows <= 1_000 for r in made) and sum(r.rows for r in made) == 5_000
    # Rows of a folder are brought together: not a file from every task.
    assert len(made) == 6
    again = tables.file_rows(tables.write_table(rows.limit(10), path, "append", 1_000, ["folder"]))
    assert sum(r.rows for r in again.collect()) == 10 and tables.read_table(spark, path).count() == 5_010
    none = tables.write_table(rows.limit(0), path, "append", 1_000, ["folder"])
    assert tables.file_rows(none).collect() == []
    # Without a size, a task writes its own file.
    assert tables.write_table(rows, str(tmp_path / "plain")).count() == 7


def test_preview(spark, capsys):
    tables.preview(spark.range(20).selectExpr("id", "repeat('x', 30) AS t"), 3)
    short = capsys.readouterr().out
    assert "|  2|" in short and "|  3|" not in short and "..." in short
    tables.preview(spark.range(20).selectExpr("repeat('x', 30) AS t"), full=True)
    assert "x" * 30 in capsys.readouterr().out


def test_rows_arrow_views(spark, capsys):
    df = tables.inline_table(spark, {"a": [1]}, "a int").selectExpr("a", "struct(a, array(struct(a))) AS s")
    assert tables.to_rows(df) == [{"a": 1, "s": {"a": 1, "col2": [{"a": 1}]}}]
    arrow = tables.to_arrow(df.select("a"))
    assert tables.from_arrow(spark, arrow).collect() == df.select("a").collect()
    tables.register(df, "some_name")
    assert spark.sql("SELECT a FROM some_name").first().a == 1
    kept = tables.keep(df, 1)
    assert kept.is_cached and "|  1|" in capsys.readouterr().out
    kept.unpersist()


def test_shared_dir(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (named.rstrip("/") if named else session.shared_dir(spark))
    written = session.written(spark.range(3), "ids")
    assert written.count() == 3 and written.inputFiles()[0].removeprefix("file://").startswith(session.shared_dir(spark))


def test_public_bucket_conf():
    conf = tables.public_bucket_conf("eu-west-1")
    assert conf["spark.hadoop.fs.s3a.endpoint.region"] == "eu-west-1" and len(conf) == 2
