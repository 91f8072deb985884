import random
import re

from pyspark.sql import functions as F

from commitlens.functions import answers, display, lists, text, times
from commitlens.schemas import COMMIT_QUALITY


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("c"))).collect()]


def test_normalize(spark):
    clean = lambda c: text.normalize(c, remove_punct=True, lowercase=True, white_space=True)
    assert apply(spark, ["  O'Neil-Smith  Jr. ", "!!!", "É  a\t\nB", None], clean) == ["oneilsmith jr", "", "é a b", None]


def test_guess_markup_against_restatement(spark):
    def restated(t):
        if t is None:
            return "unknown"
        md = bool(re.search(r"\[[^\]]+\]\(http", t)) + bool(re.search(r"^\s*#{1,6}\s+\S", t, flags=re.M))
        rst = bool(re.search(r"^\.\.\s+\w+::", t, flags=re.M)) + bool(re.search("^[=\\-`:\\.'^~*+#]+(\\r?\\n)+", t, flags=re.M))
        return "markdown" if md > rst else "rst" if rst > md else "unknown"

    rng = random.Random(3)
    alphabet = ["#", " ", "\n", "\r\n", "=", "-", "a", "é", "[x](http://y)", "[", "](http", ".. note::", ".", " ", " ", "\t", "::", "`"]
    texts = [None, ""] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(3000)]
    assert apply(spark, texts, text.guess_markup) == [restated(t) for t in texts]


def test_truncate_against_restatement(spark):
    def restated(t):
        return " ".join("\n".join(t.split("\n")[:500]).split()[:10000])

    texts = ["", " \n ", "a b", "x\ty  z\n" * 700, "w " * 10001, " a b\x1fc", "\n" * 501 + "late"]
    assert apply(spark, texts, text.truncate_message) == [restated(t) for t in texts]


def test_strip(spark):
    values = ["\t a b　\x1c", "\x85x", "", None]
    assert apply(spark, values, text.strip) == [v if v is None else v.strip() for v in values]


def test_plain_text(spark):
    md = "# Title #\n\n> quoted [link](http://x \"t\") ![pic](p.png)\n\n```py\ncode\n```\n**bold** and *soft* `c`\n"
    assert apply(spark, [md], text.to_plain) == ["Title\n\nquoted link pic\n\ncode\nbold and soft c\n"]
    rst = "Title\n=====\n\n.. code:: py\n\nSee :ref:`here` and `site <http://x>`_ ``lit`` **b**\n"
    assert apply(spark, [rst, "as it is"], text.to_plain) == ["Title\n\n\nSee here and site lit b\n", "as it is"]


def test_text_from_bytes(spark):
    values = [b"a\r\nb\rc\n", b"\xff", None, "é".encode()]
    got = apply(spark, [None if v is None else bytearray(v) for v in values], text.text_from_bytes, "binary")
    assert got == ["a\nb\nc\n", None, None, "é"]


def test_data_uri(spark):
    assert apply(spark, [bytearray(range(100))], text.data_uri, "binary")[0].startswith("data:image/png;base64,AAECAwQF")
    assert len(apply(spark, [bytearray(100)], text.data_uri, "binary")[0]) == 22 + 136


def test_fill(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(text.fill("a={a} b={b}.", a=F.col("a"), b=F.col("b"))).first()[0] == "a=1 b=None."


def test_lists(spark):
    values = [["Rust", " C  ++ ", "a|B"], [], None, [None, "x"]]
    assert apply(spark, values, lists.normalize_items, "array<string>") == [["rust", " c ++ ", "a", "b"], [], None, ["x"]]
    legacy = lambda c: lists.normalize_items(c, legacy=True)
    assert apply(spark, values, legacy, "array<string>")[1] == [""]
    assert apply(spark, [["b c d", "a"]], lists.hyphenate, "array<string>") == [["a", "b-c-d"]]
    assert apply(spark, [["b", "a", "b"]], lambda c: lists.first_distinct(c, 1), "array<string>") == [["a"]]
    assert apply(spark, ["java|Machine-Learning", "javascript", ""], lambda c: lists.pipe_member(c, "java")) == [True, False, False]


def test_dates(spark):
    got = apply(spark, ["2024-03-01 10:00:00 +0530", "2024-03-01", "", None], lambda c: times.commit_date(c).cast("string"))
    assert got == ["2024-03-01 04:30:00", None, None, None]
    assert apply(spark, ["2024-03-01 10:00:00", "x"], times.display_date) == ["3/1/2024", None]


def test_answers(spark):
    texts = [
        '{"impact_to_project": 1, "technical_ability": 10, "reason": "r"}',
        '{"impact_to_project": 0, "technical_ability": 10, "reason": "r"}',
        '{"impact_to_project": 1, "technical_ability": 11, "reason": "r"}',
        '{"impact_to_project": "many", "technical_ability": 1, "reason": "r"}',
        '{"impact_to_project": 1, "technical_ability": 1}',
        "sorry",
        None,
    ]
    got = apply(spark, texts, lambda c: answers.parse_answer(c, COMMIT_QUALITY, answers.QUALITY_BOUNDS))
    assert got[0].asDict() == {"impact_to_project": 1, "technical_ability": 10, "reason": "r"}
    assert got[1:] == [None] * 6


def test_display(spark):
    scores = [[3.9], [4.0], [6.0], [8.0], [8.35, 8.35], [], [2.0, 2.1], [None, 3.0]]
    sums = lambda c: F.aggregate(c, F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0)))
    means = apply(spark, scores, lambda c: display.mean_score(sums(c), F.size(c)), "array<double>")
    assert means == [3.9, 4.0, 6.0, 8.0, 8.4, 0.0, 2.1, 1.5]
    assert apply(spark, means[:7], display.ability_band, "double") == ["gray", "yellow", "blue", "green", "green", "gray", "gray"]
    colors = [tuple(c) for c in apply(spark, [" Rust ", "c#", "Nope", None], display.language_color)]
    other = ("bg-gray-100", "text-gray-800")
    assert colors == [("bg-[#DEA584]", "text-black"), ("bg-[#239120]", "text-white"), other, other]
