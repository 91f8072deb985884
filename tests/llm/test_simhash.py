import random

import numpy as np
import pytest
import xxhash

from commitlens.llm import simhash


def restated(text, n=3):
    words = []
    for part in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").split(" "):
        if part:
            words.append(part)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=3):
    """rows: (id, fp); label by spreading the smallest id over all near pairs."""
    label = {k: i for k, (i, _) in enumerate(rows)}
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                    least = min((x for x in (label[a], label[b]) if x is not None), default=None)
                    if label[a] != least or label[b] != least:
                        label[a] = label[b] = least
                        changed = True
    return label


def test_fingerprint():
    rng = random.Random(5)
    for _ in range(60):
        text = " ".join(rng.choice(["The", "ein", "là", "ÀB", "x\ny", "Q"]) for _ in range(rng.randrange(0, 40)))
        assert simhash.fingerprint(text) == restated(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n\t") == 0
    long = "ab cd ef gh " * 50_000
    assert simhash.fingerprint(long) == restated(long)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    for k in range(0, 140, 3):
        for bit in rng.choice(64, rng.integers(0, 9), replace=False):
            fps[k + 1] = fps[k + 1] if bit % 2 else fps[k]
            fps[k] ^= np.uint64(1) << np.uint64(bit)
    queries = fps[::2]
    q, lane = simhash.within(queries, simhash.planes_of(fps), len(fps), radius)
    want = {(i, j) for i, a in enumerate(queries) for j, b in enumerate(fps) if (int(a) ^ int(b)).bit_count() <= radius}
    assert set(zip(q.tolist(), lane.tolist(), strict=True)) == want


@pytest.mark.parametrize("cell", [4, 32_768])
def test_links_connect_all_near_fingerprints(spark, cell):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for fp in list(fps)[:25]:
        for _ in range(rng.randrange(1, 6)):
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                fp ^= 1 << bit
            fps.add(fp)
    # One crowded key: the same high bits.
    fps |= {(1 << 62) + (rng.getrandbits(12) << 3) for _ in range(60)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, block=16, cell=cell).collect()
    masked = (1 << 64) - 1
    assert all(((r.a ^ r.b) & masked).bit_count() <= 3 for r in links)
    order = sorted(signed)
    want = components([(i, f & masked) for i, f in enumerate(order)])
    root = {f: f for f in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        a, b = sorted((find(r.a), find(r.b)))
        root[b] = a
    assert {i: order.index(find(f)) for i, f in enumerate(order)} == want


ROWS = [
    (7, "one two three four five six seven eight nine ten", "x"),
    (3, "One two THREE four five six seven eight nine ten", "y"),
    (9, "one  two three\nfour five six seven eight nine ten", None),
    (9, "one  two three\nfour five six seven eight nine ten", None),
    (1, "quite another text about nothing in particular", "x"),
    (20, None, "x"),
    (21, "", "x"),
    (22, " \n ", "x"),
    (None, "one two three four five six seven eight nine ten", "x"),
    (None, "no id at all here", "x"),
    (30, "lang " * 30_000, "x"),
]


def test_components_and_kept_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, fp string").withColumnRenamed("fp", "component_id")
    got = simhash.simhash_duplicates(docs).collect()
    fps = [(i, restated(t)) for i, t, _ in ROWS]
    labels = components(fps)
    want = sorted(((i, f"{fp:016x}", labels[k]) for k, (i, fp) in enumerate(fps)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 20, 30, None], key=repr)


def test_rows_are_kept_not_ids(spark):
    a, b, c, d, e = ("".join(f"{w}{i} " for i in range(60)) for w in ("ant", "bee", "cow", "dog", "elk"))
    rows = [(2, a), (7, a), (7, b), (9, c), (9, d), (2, e), (None, b), (None, a + "end"), (None, None), (None, ""), (4, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted([(2, a), (7, b), (9, c), (9, d), (2, e), (4, " ")], key=repr)
    for _ in range(2):
        assert sorted((tuple(r) for r in simhash.keep_one_each(docs).collect()), key=repr) == want
    # A hot id is no window of one task.
    plan = simhash.keep_one_each(docs)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_duplicates(docs).collect() == []
    assert simhash.keep_one_each(docs).collect() == []
