import hashlib
import random
import re

import numpy as np
import pytest

from commitlens.llm import fim
from commitlens.llm.fim import Characters, Plan

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def restated(doc_id, text, plan):
    text = text or ""
    units = TOKENS.findall(text) if plan.unit == "token" else list(text)
    n = len(units)
    h = hashlib.sha256(f"{plan.seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    signs = (plan.prefix, plan.suffix, plan.middle)
    if doc_id is None or not text or any(s in text for s in signs) or h3 % 100 >= plan.rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < plan.spm_rate:
        return n, "spm", len(p), len(m), plan.suffix + s + plan.prefix + p + plan.middle + m
    return n, "psm", len(p), len(m), plan.prefix + p + plan.suffix + s + plan.middle + m


def test_characters_and_bytes():
    rng = random.Random(2)
    for alphabet in ("ab c", "aé漢🙂 ", "🙂", "é"):
        text = "".join(rng.choice(alphabet) for _ in range(500))
        raw = np.frombuffer(text.encode(), np.uint8)
        chars = Characters(raw)
        at = np.arange(len(text) + 1)
        places = np.array([len(text[:i].encode()) for i in at])
        assert chars.length == len(text) and np.array_equal(chars.to_bytes(at), places) and np.array_equal(chars.to_characters(places), at)
    empty = Characters(np.empty(0, np.uint8))
    assert empty.length == 0 and empty.to_bytes(np.array([0])).tolist() == [0]


def rows():
    rng = random.Random(3)
    bits = ["the", "größe", "漢字", "🙂", "\n", "\t ", "\x0b", "\x1c", " ", "<P", ">", "<", "S>", "M"]
    for i in range(400):
        yield i, "".join(rng.choice(bits) + rng.choice([" ", "", "  "]) for _ in range(rng.randrange(0, 40)))
    yield from [(1000, None), (1001, ""), (1002, " "), (1003, "a<S>b"), (1003, "a b"), (1003, "a b"), (None, "no id at all"), (1004, "x é " * 60_000)]


@pytest.mark.parametrize("plan", [Plan(), Plan(rate=100, spm_rate=50, unit="character", seed=7), Plan(rate=100, prefix="[pre]", suffix="[suf]", middle="[mid]")])
def test_texts_are_cut_and_restored(spark, plan):
    data = [(i, t, k) for k, (i, t) in enumerate(rows())]
    docs = spark.createDataFrame(data, "doc_id long, text string, form int").repartition(3)
    made = fim.transform(docs, plan)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:])[:300])
    want = sorted(((i, *restated(i, t, plan)) for i, t, _ in data), key=key)
    assert sorted((tuple(r) for r in made.collect()), key=key) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = made.select("doc_id", fim.restored(plan).alias("t")).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t, _ in data), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((tuple(r) for r in fim.digests(made, plan).collect()), key=key)
    texts = [(i, *restated(i, t, plan), t or "") for i, t, _ in data]
    assert got == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in texts), key=key)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.transform(empty)).collect() == []
    for wrong in ({"unit": "word"}, {"prefix": ""}, {"prefix": "<S>"}, {"prefix": "aba"}, {"prefix": "x<", "suffix": "<y"}):
        with pytest.raises(ValueError):
            Plan(**wrong)
