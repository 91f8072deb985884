import itertools
import time

from pyspark.sql import functions as F

from commitlens.llm import licenses, pii
from commitlens.llm.scans import largest_before, replaced, smallest_behind, sums_before


def test_running_values(spark):
    rows = [[], [5], [3, 1], list(range(50)), [7, 2, 9, 4] * 25 + [1]]
    df = spark.createDataFrame([(r,) for r in rows], "v array<bigint>")
    got = df.select(F.expr(sums_before("v")).alias("s"), F.expr(largest_before("v")).alias("l"), F.expr(smallest_behind("v")).alias("b")).collect()
    for v, r in zip(rows, got, strict=True):
        assert r.s == [0, *itertools.accumulate(v)][: len(v)]
        assert r.l == [-1, *itertools.accumulate(v, max)][: len(v)]
        assert r.b == [min(v[i + 1 :], default=2**63 - 1) for i in range(len(v))]


def test_replacing_spans(spark):
    text = "".join(chr(0x61 + i % 26) if i % 7 else "é" for i in range(400))
    every = [[], [(0, 1, "A")], [(0, 400, "")], [(3, 5, "x"), (5, 9, "yy"), (399, 400, "z")], [(i, i + 2, f"<{i}>") for i in range(0, 400, 3)]]
    df = spark.createDataFrame([(text, s) for s in every], "t string, s array<struct<start:bigint,end:bigint,put:string>>")
    for spans, r in zip(every, df.select(F.expr(replaced("t", "s")).alias("o")).collect(), strict=True):
        want, at = "", 0
        for a, b, put in spans:
            want, at = want + text[at:a] + put, b
        assert r.o == want + text[at:]


def seconds(run):
    started = time.monotonic()
    run()
    return time.monotonic() - started


def test_texts_with_very_many_hits(spark):
    """Ten times the hits in one text take about ten times as long, not a hundred times."""

    def texts(n):
        mails = " ".join(f"m{i}@example.org" for i in range(n)) + " tail"
        return spark.createDataFrame([(1, mails, len(mails))], "doc_id bigint, text string, n_chars bigint")

    def masked(n):
        out = pii.mask(texts(n), length_column="n_chars").first()
        assert out.text == "[EMAIL] " * n + "tail" and out.n_chars == 8 * n + 4

    def found(n):
        r = pii.span_digests(pii.find_spans(texts(n))).first()
        assert r.n_email == n and r.spans.startswith("email:0:14,") and r.spans.count(",") == n - 1

    def labelled(n):
        text = "released under the mit license . " * n
        r = licenses.license_labels(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
        assert (r.n_base, r.first_word, r.last_word) == (n, 3, 5 * n - 2)

    for run in (masked, found, labelled):
        run(100)
        few = seconds(lambda: run(2_000))  # noqa: B023
        assert seconds(lambda: run(20_000)) < 30 * few + 5  # noqa: B023
