import hashlib
import random
import re

from commitlens.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = [int(c) for c in hit if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and doubled % 10 == 0
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def restated(text):
    spans = [
        (m.start(), pii.BASE.index(kind), kind, m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)]


SECRET = "04dbebab91ab85687d33eeaaf9ac699e1180aabb"
TEXTS = [
    None, "", " ", "nothing here", "a.b@c.de", "x a@b.c%x@d.e y", "a@b..c a@b.c. a@b.c-", "é🙂 me@site.example.com, you@x.y",
    "1.2.3.4.5.6.7.8", "300.1.1.1 0.0.0.0 001.02.3.0255", "12.34.56.78.", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "4111111111111111 4111111111111111", "1 2  3 4- 5", "+1 (389) 555-5010", "+1 23", "+49 (0)30 1234567890123", "x+1 4111111111111111.",
    f'token = "{SECRET}"', f"sha {SECRET}", "a" * 40, "0" * 9_000, "1-" * 4_000 + "1", "a.b" * 4_000 + "@" + "c." * 4_000 + "de",
    "9 " * 8_000, "call 212-555-0100 now", "ssn 123-45-6789", "joe at example dot com", "iban DE89370400440532013000",
    "a@b.co " * 500, "٣.٣.٣.٣ １", "+" * 3_000, "1.1.1.1@2.2.2.2",
]


def mixed(n):
    rng = random.Random(8)
    bits = ["a", "@", ".", "b-", "1", "22", "255", "256", " ", "-", "+", "(", ")", "4111111111111111", "+1 (389) 555-5010", "é", "🙂", "%", "x@y.z"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_base_spans_and_digests(spark):
    rows = [(None if i == 3 else i % 60, t, "x") for i, t in enumerate(TEXTS + mixed(400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.find_spans(docs)
    got = [tuple(r) for r in pii.span_digests(found).collect()]

    def row(i, t):
        spans = restated(t)
        counts = [sum(s.startswith(f"{k}:") for s in spans) for k in pii.BASE]
        return (i, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())

    assert sorted((g[:6] for g in got), key=repr) == sorted((row(i, t) for i, t, _ in rows), key=repr)
    for r in found.collect():
        spans = [tuple(s) for s in r.spans]
        assert set(map(tuple, r.base)) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def corpus(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshrd") for _ in range(rng.randrange(2, 24)))
    rows = []
    for i in range(200):
        text = " ".join(word() for _ in range(30))
        if i % 4 == 0:
            text += ' token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '" ' + word()
        if i % 5 == 0:
            text += f" mail me{i}@mail.example.com or +1 (212) 555-{1000 + i} {word()}"
        rows.append((i, text))
    return spark.createDataFrame(rows, "doc_id int, text string"), rows


def test_the_classifier_adds_secrets_and_leaves_long_words_alone(spark):
    docs, rows = corpus(spark)
    for r in pii.find_spans(docs).collect():
        added = [text[s.start : s.end] for s in r.spans if s.kind not in pii.BASE for text in [rows[r.doc_id][1]]]
        assert added == re.findall('"([0-9a-f]{40})"', rows[r.doc_id][1])


def test_labelers_reliabilities(spark):
    docs, _ = corpus(spark)
    model = pii.fit(pii.with_candidates(docs, "c").select("c"), "c")
    assert all(0.5 <= a <= 0.99 for a in model.reliability.values())
    assert model.reliability["form"] > 0.8
    empty = pii.fit(pii.with_candidates(docs.where("false"), "c").select("c"), "c")
    assert empty.weights == {} and empty.bias == 0


def test_mask(spark):
    _, more = corpus(spark)
    rows = [(1, "é a@b.co 🙂 10.0.0.1", 9, 1), (2, None, 0, 2), (3, "clean", 5, 3), (None, "+1 (389) 555-5010 x", 9, 4), (1, "é a@b.co 🙂 10.0.0.1", 9, 1)]
    rows += [(i + 10, t, len(t), 0) for i, t in more]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, candidates long")
    done = pii.mask(docs, length_column="n_chars")
    assert done.columns == docs.columns
    got = {(r.doc_id, r.text, r.n_chars, r.candidates) for r in done.where("candidates > 0").collect()}
    first = "é [EMAIL] 🙂 [IP]"
    assert got == {(1, first, len(first), 1), (2, None, 0, 2), (3, "clean", 5, 3), (None, "[PHONE] x", 9, 4)}
    assert done.count() == len(rows)
    secrets = done.where("text like '%token = \"[SECRET]\"%'").count()
    assert secrets == 50 and done.where("text like '%@mail%'").count() == 0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.span_digests(pii.find_spans(docs)).collect() == []
    assert pii.mask(docs).collect() == []
