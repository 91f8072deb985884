import random
import re

import pytest

from commitlens.llm import licenses

GAP = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in GAP.split(lowered) if w]


def base(ws):
    hits = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(ws)) if ws[i : i + len(p)] == p]
    return hits


def detections(ws):
    """All rules over all texts, without gate or keyword; then containment by pairs."""
    text = " ".join(ws)
    found = []
    for number, r in enumerate(licenses.rules()):
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", text):
            start = text[: m.start()].count(" ")
            found.append((start, start + m.group().count(" ") + 1, r.tier, number, r.label, r.confidence))

    def beaten(d):
        return any(
            e != d and e[0] <= d[0] and e[1] >= d[1] and (e[2], e[0] - e[1], e[3]) < (d[2], d[0] - d[1], d[3]) and e[2] <= d[2]
            for e in found
        )

    return [d for d in found if not beaten(d)]


def restated(i, text):
    ws = words(text)
    hits, found = base(ws), detections(ws)
    starts = [s for s, _ in hits]
    miss = 1.0
    for _ in hits:
        miss *= 1 - 0.8
    for d in found:
        miss *= 1 - d[5]
    return (
        i, len(ws), len(hits), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in hits})), ",".join(sorted({x for _, x in hits} | {d[4] for d in found})),
        round(1 - miss, 6),
    )


TEXTS = [
    None, "", " \n", "no words of that kind", "MIT License", "mit -- LICENSE. Mit license", "ÀMIT License", "smit license",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.", "CC BY", "cc-by 4.0 and CC BY-SA 3.0", "cc\nby cc by", "accby cc bya",
    "SPDX-License-Identifier: GPL-2.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
    "Copyright (c) 2020 A B. All rights reserved.", "released into the public domain", "the BSD 3-Clause License and the ISC licence",
    "GNU Lesser General Public License v2.1 or later", "Kelvin K mıt License İ", "apache license " * 3_000, "x " * 20_000 + "mit license",
    "X11 license, Expat licence; GNU LGPL 2.1, gfdl v1.3", "creative commons attribution-noncommercial-noderivs 3.0 unported",
    "the revised BSD", "2-clause bsd. original bsd licence", "the Unlicense", "CeCILL 2.1, WTFPL", "mit-x11", "AGPL-3.0",
    "licensed under the terms of the Mozilla Public License, v. 2.0", "{}[]~`@", "gnu general public license apache license",
]


def mixed(n):
    rng = random.Random(4)
    bits = " ".join(t for t in TEXTS if t and len(t) < 200).split() + ["GNU General Public License", "MIT", "License", "CC BY", "2.0"]
    return [" ".join(rng.choice(bits) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_hundreds_of_rules_and_the_gate_lets_all_through():
    made = licenses.rules()
    assert len(made) > 250 and len({r.pattern for r in made}) == len(made)
    assert [r.tier for r in made] == sorted(r.tier for r in made)
    gap, start = "[^0-9A-Za-z\x80-\U0010ffff]+", licenses._GATE_STARTS
    gate = re.compile("(?i)(?<![0-9A-Za-z\x80-\U0010ffff])" + start + "(?:" + licenses.GATE.replace(" ", gap) + ")")
    for text in TEXTS + mixed(150):
        ws = words(text)
        if base(ws) or detections(ws):
            assert gate.search(text), text
        for d in detections(ws):
            assert made[d[3]].keyword in " ".join(ws)


def example(parsed, rng, least):
    """A text that the parsed pattern matches; optional parts are left out with ``least``, else at random."""
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            picks = [chr(a) for o, a in arg if str(o) == "LITERAL"] + [chr(a[0]) for o, a in arg if str(o) == "RANGE"]
            out += rng.choice(picks)
        elif name == "NOT_LITERAL":
            out += "z"
        elif name == "BRANCH":
            out += example(rng.choice(arg[1]), rng, least)
        elif name == "SUBPATTERN":
            out += example(arg[3], rng, least)
        elif name == "MAX_REPEAT":
            out += "".join(example(arg[2], rng, least) for _ in range(arg[0] if least else rng.randint(arg[0], min(arg[1], arg[0] + 2))))
        else:
            raise ValueError(name)
    return out


def bare_examples():
    rng = random.Random(8)
    for r in [*licenses.rules(), *(licenses.Rule(p, p, label, 0, 0.8) for p, label in licenses.BASE.items())]:
        parsed = re._parser.parse(r.pattern)
        for text in {example(parsed, rng, least) for least in (True, False) for _ in range(25)}:
            assert re.fullmatch(r.pattern, text) and r.keyword in text, (r, text)
            yield text


def test_the_gate_lets_a_bare_example_of_every_rule_through(spark):
    gap, start = "[^0-9A-Za-z\x80-\U0010ffff]+", licenses._GATE_STARTS
    gate = re.compile("(?i)(?<![0-9A-Za-z\x80-\U0010ffff])" + start + "(?:" + licenses.GATE.replace(" ", gap) + ")")
    assert [t for t in bare_examples() if not gate.search(t)] == []
    texts = ["Released under BSD 3-Clause", "BSD-2-Clause", "(bsd 4 clause)"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(docs).collect()}
    assert got == {i: (restated(i, t)[6], restated(i, t)[7]) for i, t in enumerate(texts)}
    assert [got[i][0] for i in range(3)] == ["bsd-3-clause", "bsd-2-clause", "bsd-4-clause"]


@pytest.mark.parametrize("more", [0, 150])
def test_scan_agrees_with_all_rules_over_all_texts(spark, more):
    rows = [(None if i == 4 else i % 20, t, 1) for i, t in enumerate(mixed(more) if more else TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels int")
    got = [tuple(r) for r in licenses.license_labels(docs).collect()]
    assert sorted(got, key=repr) == sorted((restated(i, t) for i, t, _ in rows), key=repr)


def test_empty(spark):
    assert licenses.license_labels(spark.createDataFrame([], "doc_id long, text string")).collect() == []
