import math
import random
from collections import Counter

import pytest

from commitlens.llm import fertility
from commitlens.llm.queries import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def split(text):
    return [w for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]


def repeats(words, n=8):
    seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    covered = {j for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
    return len(covered)


def restated(text, pieces):
    words, earlier, dup = split(text), set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            dup += line in earlier
            earlier.add(line)
    ids = [i for w in words for i in pieces.encode(w)]
    n = Counter(ids)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values()) if ids else 0.0
    marks = sum(all(c in fertility.SYMBOLS for c in p) and p != "" for p in (pieces.IdToPiece(i).lstrip("▁") for i in ids))
    chars = sum(map(len, words))
    symbols = sum(c in fertility.SYMBOLS for c in text or "")
    failed = len(words) < 20 or 100 * repeats(words) > 30 * len(words)
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats(words),
        "n_tokens": len(ids), "chars_per_token": chars / len(ids) if ids else 0.0, "token_entropy": entropy,
        "fallback_share": sum(pieces.IsByte(i) for i in ids) / len(ids) if ids else 0.0, "symbol_share": marks / len(ids) if ids else 0.0,
        "base_failed": failed,
    }


def texts(n):
    rng = random.Random(5)
    bits = ["the", "Thtion,", "über", "señor", "漢字", "привет", "🙂", "###", "|", "a|b", "x$$$", "\n", "\n\n", "\t", "\x0b", " ", "é", "1984", "."]
    for _ in range(n):
        body = " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 80)))
        yield body + (" " + body[: rng.randrange(200)] if rng.random() < 0.5 else "")
    yield from ["", " \n", "a", "line\nline\n\n \nline", "w " * 30_000, "word" * 20_000, "\n".join(["same line of words here"] * 50)]


def test_measures(spark, pieces):
    sample = [None, *texts(120)]
    rows = [(None if i == 7 else i % 100, t, True) for i, t in enumerate(sample)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    got = sorted((r.asDict() for r in fertility.quality_measures(docs, PATH).collect()), key=repr)
    want = sorted(({"doc_id": i, **restated(t, pieces)} for i, t, _ in rows), key=lambda w: repr((w["doc_id"], w["n_words"])))
    got.sort(key=lambda w: repr((w["doc_id"], w["n_words"])))
    for g, w in zip(got, want, strict=True):
        for name, value in w.items():
            assert g[name] == (pytest.approx(value) if isinstance(value, float) else value), (name, w)
        band = fertility.BANDS[g["script"]]
        good = band.least_chars_per_token <= g["chars_per_token"] <= band.most_chars_per_token
        good = good and g["fallback_share"] <= band.most_fallback_share and g["symbol_share"] <= band.most_symbol_share
        good = good and (g["n_tokens"] < band.entropy_from or g["token_entropy"] >= band.least_entropy)
        assert g["kept"] == (good and not g["base_failed"])


@pytest.mark.parametrize(
    "text, want",
    [("", "latin"), ("123", "latin"), ("über straße", "latin"), ("привет мир the", "cyrillic"), ("αβγ", "greek"), ("漢字かな", "cjk"), ("שלום", "other"), ("한국어", "cjk")],
)
def test_script(text, want):
    assert fertility.script(text) == want


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    judged = fertility.quality_measures(docs, PATH).join(labels, "doc_id").where("NOT base_failed")
    share = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert share.get((1, False), 0) == 0 and share.get((0, True), 0) <= 0.1 * share[(0, False)]


def test_keep_good(spark):
    good = "a plain sentence with enough different words in it to pass every rule that the measures of this module know of today"
    rows = [(1, good, 1), (1, good, 2), (None, good, 3), (2, None, 4), (3, "short", 5), (4, "w " * 40, 6), (5, "x### y$$$ | %%% && " * 3 + good, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    kept = fertility.keep_good(docs, PATH)
    assert kept.columns == docs.columns
    assert sorted(r.quality for r in kept.collect()) == [1, 2, 3]
    assert fertility.keep_good(docs.where("false"), PATH).collect() == []
    assert fertility.quality_measures(docs.where("false"), PATH).collect() == []
