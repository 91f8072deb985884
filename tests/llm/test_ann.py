import math
import random

import numpy as np
import pytest

from commitlens.llm import ann


def brute(rows, k, every):
    """rows: {id: vector} of those that take part."""
    out = {}
    for q, v in rows.items():
        if q % every == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows.items() if i != q))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_few_rows_are_searched_exactly(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 2.0]) for _ in range(5)], "x") for i in range(90)]
    rows += [(200, [0.0] * 5, "zero"), (220, None, "x"), (240, [1.0, None, 0.0, 0.0, 0.0], "x"), (260, [math.nan, 1.0, 0.0, 0.0, 0.0], "x")]
    rows += [(280, [math.inf, 1.0, 0.0, 0.0, 0.0], "x"), (300, [1.0, 2.0], "short"), (None, [1.0] * 5, "x"), (20, rows[20][1], "again"), (320, [], "x")]
    good = {i: v for i, v, _ in rows[:90] if any(v)}
    got = results(ann.nearest(frame(spark, rows), k=7, every=20))
    want = brute(good, 7, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(i, [1.0, float(i)], "x") for i in range(0, 60, 20)]
    got = results(ann.nearest(frame(spark, rows), k=20, every=20))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [20, 40], 20: [40, 0], 40: [20, 0]}
    assert results(ann.nearest(frame(spark, rows[:1]), k=20, every=20)) == {}
    assert results(ann.nearest(frame(spark, []), k=20, every=20)) == {}


def test_lists_and_hot_vector(spark):
    """Over a thousand rows, a third of them one vector: recall, exact scores, ties by id, whole answers."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2_400, 24)) + 3 * rng.normal(size=(12, 24))[rng.integers(0, 12, 2_400)]
    x = x.astype(np.float32)
    x[::3] = x[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    docs = frame(spark, rows)
    got = results(ann.nearest(docs, k=20, every=20))
    products = x.astype(float) @ x.astype(float).T
    hits = 0
    for q in range(0, len(x), 20):
        order = sorted((j for j in range(len(x)) if j != q), key=lambda j: (-round(products[q, j], 9), j))[:20]
        assert len(got[q]) == 20
        hits += len({i for i, _ in got[q]} & set(order))
        for i, s in got[q]:
            assert s == pytest.approx(products[q, i], abs=1e-9)
        assert [(-round(s, 9), i) for i, s in got[q]] == sorted((-round(s, 9), i) for i, s in got[q])
    assert hits / (20 * len(got)) >= 0.9


def test_answers_come_from_the_visited_lists_alone(spark, monkeypatch):
    """The sample gives no answers, not even where it is the whole table; every query has all its answers."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1_500, 12))
    kept, train = [], ann.train

    def one_probe(*args, **kwargs):
        kept.append(train(*args, **kwargs))
        kept[0].probes = 1
        return kept[0]

    monkeypatch.setattr(ann, "train", one_probe)
    got = results(ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), k=20, every=20))
    index = kept[0]
    home = ann._distances(index.rows(x), index.centres).argmin(axis=1)
    sizes = np.bincount(home, minlength=len(index.centres))
    assert len(got) == 75
    for q, answers in got.items():
        lists = index.visited(x[[q]], sizes, 20)[0]
        assert len(lists) < len(sizes) and len(answers) == 20
        assert {home[i] for i, _ in answers} <= set(lists.tolist())


def test_recall_on_a_table_of_many_samples(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 512)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(5_000, 24)) + 2 * rng.normal(size=(15, 24))[rng.integers(0, 15, 5_000)]
    got = results(ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), k=20, every=20))
    products = x[::20] @ x.T
    products[np.arange(250), np.arange(0, 5_000, 20)] = -np.inf
    best = np.argsort(-products, axis=1)[:, :20]
    assert all(len(v) == 20 for v in got.values()) and len(got) == 250
    assert sum(len({i for i, _ in got[20 * n]} & set(row.tolist())) for n, row in enumerate(best)) >= 0.9 * best.size


def test_abandoned_early_but_rarely_wrongly():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3_000, 96)) + 2 * rng.normal(size=(10, 96))[rng.integers(0, 10, 3_000)]
    ids = np.arange(len(x))
    top = float((x * x).sum(axis=1).max())
    index = ann.train(ids[:1_500], x[:1_500], 800, top, 10, 0.97)
    q = np.arange(0, 3_000, 50)
    parts = ann.scan(q, x[q], np.full(len(q), np.inf), ids, x, index, 10)
    found = set(zip(np.concatenate([p[0] for p in parts]).tolist(), np.concatenate([p[1] for p in parts]).tolist(), strict=True))
    products = x[q] @ x.T
    products[np.arange(len(q)), q] = -np.inf
    want = {(int(a), int(b)) for a, row in zip(q, np.argsort(-products, axis=1)[:, :10], strict=True) for b in row}
    assert len(found & want) / len(want) > 0.93
    # Distances to far rows are left before all dimensions are seen.
    partial = ann._distances((index.queries(x[q]) @ index.rotation)[:, :32], (index.rows(x) @ index.rotation)[:, :32])
    tenth = np.sort(top + (x[q] ** 2).sum(axis=1)[:, None] - 2 * products, axis=1)[:, 9]
    assert ann._near(partial, tenth[:, None], 32, 97, 0.0).mean() < 0.6
