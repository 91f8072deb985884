import pytest
from pyspark.sql import functions as F

from commitlens.functions import markup
from workload import queries

MARKDOWN = {
    "plain": ("a b\n\nc", "a b\n\nc"),
    "dunder in fence": ("x\n```py\ndef __init__(self): *a* [b](c)\n```\ny __z__", "x\ndef __init__(self): *a* [b](c)\ny z"),
    "dunder in ticks": ("call `__init__` and **`a*b`** of __x__", "call __init__ and a*b of x"),
    "double ticks": ("`` a`b `` c", "a`b c"),
    "open fence": ("a\n~~~\n# not *a* title", "a\n# not *a* title"),
    "fence in fence": ("````\n```\nx\n```\n````\ny", "```\nx\n```\ny"),
    "fence in item": ("- one\n\n  ```\n  __a__\n  ```\n- *two*", "- one\n\n  __a__\n- two"),
    "indented": ("p\n\n    __x__ = *y*\n    z\n\nq", "p\n\n__x__ = *y*\nz\n\nq"),
    "table": ("|Name|*What*|\n|:---|---:|\n| a | `x__y__` |\n| b \\| c | [l](u) |\nend", "Name  What\na  x__y__\nb | c  l\nend"),
    "table bare": ("a | b\n--|--\n1 | 2", "a  b\n1  2"),
    "reference": ("see [the docs][1], [Home][], [home] and [none][2] [x]\n\n[1]: http://a \"t\"\n[HOME]: <http://b>", "see the docs, Home, home and [none][2] [x]\n"),
    "nested links": ("[![build](b.svg)](http://ci) and [a (b)](http://h/x_(y))", "build and a (b)"),
    "nested lists": ("* a\n    * *b*\n        1. c\n+ d", "- a\n    - b\n        1. c\n- d"),
    "setext": ("Big *title*\n===\n\nsmall\n---\ntext", "Big title\n\nsmall\ntext"),
    "rules": ("a\n\n---\n\n* * *\nb", "a\n\n\nb"),
    "quote": ("> > **a**\n> b", "a\nb"),
    "heading": ("### A *b* ##\n#\n#no", "A b\n\n#no"),
    "escapes": (r"\*a\* \_b\_ \[c](d) 1\. ok", r"*a* _b_ [c](d) 1\. ok"),
    "html": ("<p align='x'>a</p><!-- c -->\n<http://h/x> 1 < 2", "a<!-- c -->\nhttp://h/x 1 < 2"),
    "comment": ("<!-- a\n**b** -->\nc", "c"),
    "emphasis": ("a_b_c *x* _y_ ***z*** 2 * 3 * 4 ~~gone~~", "a_b_c x y z 2 * 3 * 4 gone"),
    "empty": ("", ""),
    "private": ("a\ue000b `c`", "a\ufffdb c"),
    "line ends": ("# a\r\n*b*\r\n", "a\nb\n"),
}
RST = {
    "title": ("=====\nTitle\n=====\n\ntext", "Title\n\ntext"),
    "code": ("a\n\n.. code-block:: py\n   :linenos:\n\n   def __init__(*a):\n       ``x``\n\nb", "a\n\ndef __init__(*a):\n    ``x``\n\nb".replace("    ``x``", "   ``x``")),
    "literal": ("run::\n\n    *a* `b`\n\n    c\n\n*d*", "run:\n\n*a* `b`\n\nc\n\nd"),
    "bare literal": ("::\n\n  x*y*\n\nz", "x*y*\n\nz"),
    "directive": (".. note:: x\n   :class: y\n\n   *body*\n\nafter", "\n   body\n\nafter"),
    "comment": ("a\n\n.. a comment\n   goes on\n\nb", "a\n\n\nb"),
    "targets": (".. _here:\n\n.. _site: http://x\n\n`site`_ and `there <http://y>`__ and `x`", "\n\nsite and there and x"),
    "roles": (":ref:`a <b>` :py:class:`C` ``d*e*f`` **g** *h*", "a C d*e*f g h"),
    "grid": ("+---+---+\n| a | b |\n+===+===+\n| 1 | *2* |\n+---+---+\nx", "a  b\n1  2\nx"),
    "simple": ("==  ==\na   b\n==  ==\n1   2\n==  ==", "a   b\n1   2"),
    "lists": ("* a\n\n  * *b*", "- a\n\n  - b"),
    "empty": ("", ""),
}


@pytest.mark.parametrize(("cases", "read"), [(MARKDOWN, markup.markdown_to_plain), (RST, markup.rst_to_plain)])
def test_constructs(spark, cases, read):
    df = spark.createDataFrame([(n, t) for n, (t, _) in cases.items()], "n string, t string")
    assert {r.n: r.p for r in df.select("n", read(F.col("t")).alias("p")).collect()} == {n: want for n, (_, want) in cases.items()}


def test_null_and_very_long_texts(spark):
    long = "| a | b |\n|---|---|\n" + "| *x* | `y` |\n" * 20_000 + "\n" + "- item\n  more\n" * 20_000 + "```\n" + "__z__\n" * 20_000
    df = spark.createDataFrame([(None,), (long,), ("\n" * 5,)], "t string")
    got = [r[0] for r in df.select(markup.markdown_to_plain(F.col("t"))).collect()]
    assert got[0] is None and got[2] == "\n" * 5
    assert got[1] == "a  b\n" + "x  y\n" * 20_000 + "\n" + "- item\n  more\n" * 20_000 + "__z__\n" * 20_000
    literal = "a::\n\n" + "  *b*\n" * 20_000 + "\n" + ".. x\n" + "   c\n" * 20_000 + "*d*"
    df = spark.createDataFrame([(literal,)], "t string")
    assert df.select(markup.rst_to_plain(F.col("t"))).first()[0] == "a:\n\n" + "*b*\n" * 20_000 + "\nd"


def test_constructs_are_read_in_all_tasks(spark, tmp_path):
    """However few files the names lie in."""
    names = spark.range(200).selectExpr("id AS p_partkey", "CASE WHEN id % 9 > 0 THEN concat('part ', id) END AS p_name")
    names.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = queries.plain_constructs(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    tasks = found.groupBy("task").count().collect()
    assert len(tasks) == 4 and sum(t["count"] for t in tasks) == 2_000
