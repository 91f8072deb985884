import random
import zlib

import numpy as np
import pytest

from commitlens.llm import byteconv as b


def network(seed=1):
    rng = np.random.default_rng(seed)
    return b.Network(
        rng.normal(size=(b.WIDTH, 256, b.FILTERS)).astype(np.float32), rng.normal(size=b.FILTERS).astype(np.float32),
        rng.normal(size=2 * b.FILTERS + 1).astype(np.float32), 0.2,
    )


def restated(net, text):
    """Chunk by chunk, window by window."""
    data = list(text) + [0] * (b.WIDTH - len(text))
    data += [0] * ((len(data) - b.WIDTH) % b.STRIDE)
    windows = [data[i : i + b.WIDTH] for i in range(0, len(data) - b.WIDTH + 1, b.STRIDE)]
    response = [sum(net.taps[j, v] for j, v in enumerate(w)) for w in windows]
    step, span = (b.CHUNK - b.OVERLAP) // b.STRIDE, (b.CHUNK - b.WIDTH) // b.STRIDE + 1
    chunks, at = [], 0
    while True:
        chunks.append(np.maximum(np.max(response[at : at + span], axis=0) + net.bias, 0))
        if at + span >= len(windows):
            break
        at += step
    x = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0), [min(1.0, len(windows) / span)]])
    return 1 / (1 + np.exp(-np.clip(x @ net.dense + net.offset, -40, 40)))


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 10, 100, 511, 512, 513, 514, 959, 960, 961, 1407, 1408, 1409, 1410, 5_000, 62_007])
def test_every_byte_of_a_text_counts_once_per_chunk(size):
    net, rng = network(), random.Random(size)
    text = bytes(rng.randrange(256) for _ in range(size))
    assert net.score(text) == pytest.approx(restated(net, text), rel=1e-4, abs=1e-6)


def test_gradients():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 105, n, dtype=np.uint8)) for n in (5, 300, 900, 2_000)]
    docs, y = [b._chunks(t) for t in texts], np.array([1, 0, 1, 0], np.float32)
    fill = np.array([0.1, 0.5, 1.0, 1.0], np.float32)
    net = network(5)
    params = [net.taps * 0.1, net.bias * 0.1, net.dense * 0.1, np.array([0.1], np.float32)]

    def loss(p):
        total = 0.0
        taps, bias, dense, offset = (x.astype(np.float64) for x in p)
        for d, f, label in zip(docs, fill, y, strict=True):
            hidden = []
            for chunk in d:
                r = [sum(taps[j, chunk[i + j]] for j in range(b.WIDTH)) for i in range(0, b.CHUNK - b.WIDTH + 1, b.STRIDE)]
                hidden.append(np.maximum(np.max(r, axis=0) + bias, 0))
            z = np.concatenate([np.mean(hidden, axis=0), np.max(hidden, axis=0), [f]]) @ dense + offset[0]
            total += np.log1p(np.exp(-z)) if label else np.log1p(np.exp(z))
        return total / len(docs) + b.DECAY / 2 * sum((x**2).sum() for x in (taps, bias, dense))

    grads = b._gradients(params, docs, fill, y)
    spots = [(0, (0, 97, 3)), (0, (4, 100, 10)), (0, (7, 0, 1)), (1, (2,)), (1, (11,)), (2, (5,)), (2, (2 * b.FILTERS,)), (3, (0,))]
    for which, spot in spots:
        up, down = ([x.astype(np.float64).copy() for x in params] for _ in range(2))
        up[which][spot] += 1e-4
        down[which][spot] -= 1e-4
        assert grads[which][spot] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=2e-2, abs=2e-5)


def test_held_out_accuracy(spark):
    """Learned from four fifths of the labels, judged on the fifth that is never seen."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    net = b.fit(docs, labels, rows=1_500)
    held = labels.where(b.remainder("doc_id") == 0).select("doc_id", "quality")
    rows = b.score_documents(docs.join(held.select("doc_id"), "doc_id", "left_semi"), net).join(held, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > x) + 0.5 * (g == x) for g in good for x in bad])
    assert auc > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.95


ROWS = [(1, "a plain text", 1), (1, "a plain text", 1), (2, None, 1), (3, "", 0), (None, "no id", 0), (4, "long " * 30_000, 1), (5, "é", None)]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (7, 1)], "doc_id long, quality int")
    got = b.classify(docs, labels).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in ROWS), key=repr)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    none = b.classify(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert b.classify(docs.where("false"), labels).collect() == []
