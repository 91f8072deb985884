"""Every stage against a plain restatement, each on what the stage before it kept."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_fertility import restated as measured
from test_pii import restated as base_spans
from test_simhash import components
from test_simhash import restated as fingerprint

import corpus_pipeline
from commitlens.llm import fertility, mixing, pii
from commitlens.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
GOOD = "a plain sentence with enough different words in it to pass every rule that the measures of this module know of today"
MORE = [
    (9_001, None, "en", "src1", 0), (9_002, "", "en", "src1", 0), (9_003, GOOD, "en", None, 1), (9_004, GOOD.upper(), "en", "src2", 1), (9_003, GOOD, "en", None, 1),
    (None, GOOD + " without an id but with mail at nobody@example.org in it", None, "src3", None),
    (9_005, GOOD + " call +1 (389) 555-5010 or write to me@site.example.com", "en", "src3", 7),
]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage and come out of it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame(MORE, docs.schema)
    current = docs.unionByName(more).withColumns({"quality": F.lit("x"), "candidates": F.lit(1), "component_id": F.lit(2)})
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, current, SF)
        rows = [r.asDict() for r in made.collect()]
        out.append((name, current.columns, [r.asDict() for r in current.collect()], made.columns, rows))
        current = spark.createDataFrame([tuple(r.values()) for r in rows], made.schema) if name != "encode" else made
    return {name: rest for name, *rest in out}


def counted(rows):
    return Counter(tuple(r.values()) for r in rows)


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "dedup", "privacy", "mixing", "encode"]


def test_quality(stages):
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    columns, before, names, after = stages["quality"]
    assert names == columns

    def good(text):
        m, band = measured(text, pieces), fertility.BANDS[fertility.script(text or "")]
        return (
            not m["base_failed"] and band.least_chars_per_token <= m["chars_per_token"] <= band.most_chars_per_token
            and m["fallback_share"] <= band.most_fallback_share and m["symbol_share"] <= band.most_symbol_share
            and (m["n_tokens"] < band.entropy_from or m["token_entropy"] >= band.least_entropy)
        )

    assert counted(after) == counted([r for r in before if good(r["text"])])
    assert 0 < len(after) < len(before)


def test_dedup(stages):
    columns, before, names, after = stages["dedup"]
    assert names == columns
    # Components over rows, whatever their ids; of each one row stays, the smallest id first, nulls last.
    label = components([(k, fingerprint(r["text"])) for k, r in enumerate(before)])
    groups: dict = {}
    for k, r in enumerate(before):
        groups.setdefault(label[k], []).append(r)
    assert len(after) == len(groups) < len(before)
    least = Counter(min((r["doc_id"] is None, r["doc_id"] or 0) for r in g) for g in groups.values())
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == least
    assert not counted(after) - counted(before)
    members = {k: counted(g) for k, g in groups.items()}
    assert all(sum((counted(after) & m).values()) >= 1 for m in members.values())


def test_privacy(stages):
    columns, before, names, after = stages["privacy"]
    assert names == columns
    fixed = lambda rows: Counter(tuple(v for k, v in r.items() if k not in ("text", "n_chars")) for r in rows)
    assert fixed(after) == fixed(before)
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        text = texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in base_spans(text))]
        tokens = [(m.start(1), m.end(1), "secret") for m in re.finditer('token = "([0-9a-f]{40})"', text, re.I)]
        at, want = 0, ""
        for s, e, k in sorted(spans + tokens):
            if s >= at:
                want += text[at:s] + f"[{k.upper()}]"
            at = max(at, e)
        assert r["text"] == want + text[at:]


def test_mixing(stages, spark):
    columns, before, names, after = stages["mixing"]
    assert names == columns
    drawn, there = counted(after), counted(before)
    # Every document comes, none more often than the limit, and rows of one kind equally often.
    assert set(drawn) == set(there) and all(n <= 2 * there[k] for k, n in drawn.items())
    words = Counter()
    for rows, sign in ((after, "after"), (before, "before")):
        for r in rows:
            words[sign, r["source"]] += len(r["text"].split())
    sources = {s for _, s in words}
    total = sum(words["before", s] for s in sources)
    frame = spark.createDataFrame([(words["before", s] / total, words["before", s]) for s in sources], "share double, tokens long")
    alpha = mixing.exponent(frame, mixing.Mixture(0.92, 2.0))
    weights = {s: (words["before", s] / total) ** alpha for s in sources}
    scale = max(words["before", s] / weights[s] for s in sources)
    longest = max(len(r["text"].split()) for r in before)
    for s in sources:
        assert abs(words["after", s] - scale * weights[s]) <= longest + 1


def test_encode(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    _, before, names, after = stages["encode"]
    assert names == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def row(r):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False).encode()
        return r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()

    assert counted(after) == Counter(map(row, before))


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
    assert pii.KINDS[:4] == pii.BASE
