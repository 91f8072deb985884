import hashlib
import math
import random

import numpy as np
import pytest

from commitlens.llm import codes


def restated(rows, parts=4, size=8, rounds=2, scale=256):
    """(id, label, code, error) and the codebook, vector by vector."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    book = [[cut(v, p) for _, v, _ in kept[:size]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(book[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(v, p)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(book[p])])
        book = new
    out = [(i, label, [near(v, p)[1] for p in range(parts)], sum(near(v, p)[0] for p in range(parts))) for i, v, label in kept]
    return out, book


def test_the_trie_gives_nearest_entries(monkeypatch):
    rng = np.random.default_rng(1)
    for leaves, spread, width in ((1, 3, 4), (7, 3, 4), (4096, 40, 3), (64, 40_000, 5), (3, 2, 1)):
        monkeypatch.setattr(codes, "LEAVES_AT_ONCE", leaves)
        parts, place, times = codes.distinct_parts(rng.integers(-spread, spread + 1, (700, width)))
        entries = rng.integers(-spread, spread + 1, (16, width))
        entries[9] = entries[2]
        best, error = codes.nearest_entries(parts, entries)
        far = ((parts[:, None, :].astype(object) - entries[None, :, :]) ** 2).sum(axis=2)
        assert best.tolist() == far.argmin(axis=1).tolist() and error.tolist() == far.min(axis=1).tolist()
        assert times.sum() == 700 and len(place) == 700 and len(np.unique(parts, axis=0)) == len(parts)
    assert codes.nearest_entries(np.empty((0, 4), np.int64), np.zeros((3, 4), np.int64))[0].tolist() == []


def rows():
    rng = random.Random(4)
    out = [(rng.randrange(400), [rng.gauss(0, 0.4) for _ in range(8)], rng.choice([0, 1, None])) for _ in range(300)]
    out += [(500 + i, out[0][1], 1) for i in range(200)] + [(None, out[1][1], None)] * 2 + [(3, [0.25, -0.25] * 4, 2)]
    bad = [(1, None, 1), (2, [1.0, None] * 4, 1), (0, [float("nan")] * 8, 1), (0, [float("inf")] * 8, 0), (0, [0.0] * 7 + [float("-inf")], 0)]
    return out + bad


@pytest.mark.parametrize("block", [1 << 15, 50])
def test_codes_are_those_of_the_restated_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "VECTORS_AT_ONCE", block)
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows())], "vec_id long, embedding array<double>, label int, error int").repartition(4)
    coded = codes.code_vectors(df, parts=4, size=8)
    want, book = restated(rows())
    assert coded.codebook.tolist() == book
    got = [(r.vec_id, r.label, r.code, r.error) for r in coded.vectors.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert set(coded.vectors.columns) == set(df.columns) | {"code"}
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    shown = [(i, "".join(f"{c:02x}" for c in code), error, sums[label], sha) for i, label, code, error in want]
    assert sorted(map(tuple, codes.code_digests(coded).collect()), key=repr) == sorted(shown, key=repr)
    decoded = codes.decode_vectors(coded.vectors, coded.codebook).first()
    assert decoded.decoded == [x / 256 for p, c in enumerate(decoded.code) for x in book[p][c]]


def test_few_odd_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for data in ([], [(1, None, 1)], [(1, [], 1)], [(1, [1.0] * 6, 1)]):
        made = codes.code_digests(codes.code_vectors(spark.createDataFrame(data, schema), parts=4))
        assert made.collect() == [] and made.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    few = codes.code_vectors(spark.createDataFrame([(2, [0.5] * 4, 1), (1, [1.0] * 4, 1), (3, [1.0] * 8, 1)], schema), parts=2)
    assert few.codebook.shape == (2, 2, 2) and sorted((r.vec_id, r.code, r.error) for r in few.vectors.collect()) == [(1, [0, 0], 0), (2, [1, 1], 0)]
    huge = codes.code_vectors(spark.createDataFrame([(1, [3e38, -3e38], 1), (2, [0.0, 0.0], 1)], schema), parts=1, size=1, rounds=0)
    assert {r.vec_id: r.error for r in huge.vectors.collect()} == {1: 0, 2: 2 * codes.LARGEST**2}
    with pytest.raises(ValueError):
        codes.code_vectors(few.vectors, parts=0)
