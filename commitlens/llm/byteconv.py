"""A byte-level convolutional network in numpy that scores whole texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import map_columns, worker_tool

# Bytes a filter sees, bytes it moves on, and how many filters learn.
WIDTH, STRIDE, FILTERS = 8, 2, 24
# A chunk's bytes and those it shares with the next one.
CHUNK, OVERLAP = 512, 64
_STEP = (CHUNK - OVERLAP) // STRIDE
_SPAN = (CHUNK - WIDTH) // STRIDE + 1
# Windows whose responses are in memory at one time when scoring.
_WINDOWS_AT_ONCE = 64 * _STEP

#: Bounds of the training sample: labelled rows, and the longest text among them.
TRAIN_ROWS, TRAIN_CHARS = 3_000, 100_000
EPOCHS, BATCH, RATE, DECAY = 10, 32, 0.01, 3e-3


@dataclass
class Network:
    """Filters over one-hot bytes, then a dense layer over pooled responses.

    A chunk's response to a filter is its largest over the windows of the chunk, rectified. A
    document has, of each filter, the mean and the largest response of its chunks; these and how
    far its first chunk is filled make one logit. ``taps[j, v]`` is what byte ``v`` at place ``j`` of a window adds to the filters.
    """

    taps: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: float

    def score(self, text: bytes) -> float:
        """Probability of label 1 for a whole text, chunk by chunk, however long it is."""
        if not len(self.dense):
            return self.offset
        data = _padded(text)
        windows = (len(data) - WIDTH) // STRIDE + 1
        chunks = max(1, -(-(windows - (_SPAN - _STEP)) // _STEP))
        total, top = np.zeros(len(self.bias), np.float64), np.zeros(len(self.bias), np.float32)
        for first in range(0, chunks, _WINDOWS_AT_ONCE // _STEP):
            last = min(chunks, first + _WINDOWS_AT_ONCE // _STEP)
            end = min(windows, (last - 1) * _STEP + _SPAN)
            part = data[first * _STEP * STRIDE : (end - 1) * STRIDE + WIDTH]
            response = self.taps[0][part[: len(part) - WIDTH + 1 : STRIDE]]
            for j in range(1, WIDTH):
                response += self.taps[j][part[j : len(part) - WIDTH + 1 + j : STRIDE]]
            starts = np.arange(last - first) * _STEP
            edges = np.stack([starts, np.minimum(starts + _SPAN, len(response))], axis=1).ravel()
            # Every other stretch between edges is a chunk; the last one runs to the end.
            cut = edges if edges[-1] < len(response) else edges[:-1]
            pooled = np.maximum.reduceat(response, cut)[::2] if len(cut) > 1 else response.max(axis=0)[None]
            pooled = np.maximum(pooled + self.bias, 0)
            total += pooled.sum(axis=0)
            top = np.maximum(top, pooled.max(axis=0))
        x = np.concatenate([total / chunks, top, [min(1.0, windows / _SPAN)]])
        logit = float(x @ self.dense + self.offset)
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def _padded(text: bytes) -> np.ndarray:
    """The bytes, with as many zeros as make whole windows."""
    size = max(WIDTH, len(text) + (len(text) - WIDTH) % STRIDE)
    data = np.zeros(size, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return data


def _chunks(text: bytes) -> np.ndarray:
    """[chunks, CHUNK] bytes of a text for training; the last chunk is filled up with its own end."""
    data = _padded(text)
    if len(data) < CHUNK:
        data = np.concatenate([data, np.zeros(CHUNK - len(data), np.uint8)])
    starts = list(range(0, max(1, len(data) - OVERLAP), CHUNK - OVERLAP))
    return np.stack([data[min(s, len(data) - CHUNK) :][:CHUNK] for s in starts])


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Learn filters and dense layer by Adam on the logistic loss; the same sample gives the same network.

    Without rows of both labels there is nothing to learn: the network scores the share of label 1
    (0.5 without rows) for every text.
    """
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Network(np.zeros((0,)), np.zeros(0), np.zeros(0), float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    docs = [_chunks(t) for t in texts]
    filled = np.array([min(1.0, ((len(_padded(t)) - WIDTH) // STRIDE + 1) / _SPAN) for t in texts], np.float32)
    taps = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    bias = np.zeros(FILTERS, np.float32)
    dense = rng.normal(0, 0.1, 2 * FILTERS + 1).astype(np.float32)
    offset = np.array([np.log(y.mean() / (1 - y.mean()))], np.float32)
    params = [taps, bias, dense, offset]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            grads = _gradients(params, [docs[i] for i in own], filled[own], y[own])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return Network(taps, bias, dense, float(offset[0]))


def _gradients(params: list[np.ndarray], docs: list[np.ndarray], filled: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    taps, bias, dense, offset = params
    sizes = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(docs)), sizes)
    data = np.concatenate(docs)
    windows = np.arange(_SPAN) * STRIDE
    best = np.empty((len(data), FILTERS), np.int64)
    pooled = np.empty((len(data), FILTERS), np.float32)
    for at in range(0, len(data), 128):
        part = data[at : at + 128]
        response = taps[0][part[:, windows]]
        for j in range(1, WIDTH):
            response += taps[j][part[:, windows + j]]
        best[at : at + 128] = response.argmax(axis=1)
        pooled[at : at + 128] = response.max(axis=1)
    hidden = np.maximum(pooled + bias, 0)
    mean = np.add.reduceat(hidden, starts) / sizes[:, None]
    top = np.maximum.reduceat(hidden, starts)
    x = np.concatenate([mean, top, filled[:, None]], axis=1)
    p = 1 / (1 + np.exp(-np.clip(x @ dense + offset, -40, 40)))
    error = ((p - y) / len(y)).astype(np.float32)
    to_x = error[:, None] * dense
    # Chunks that tie for the largest response, as overlapping ones do, share its gradient.
    largest = (hidden == top[owner]).astype(np.float32)
    largest /= np.add.reduceat(largest, starts)[owner]
    to_hidden = (to_x[:, :FILTERS] / sizes[:, None])[owner] + to_x[:, FILTERS : 2 * FILTERS][owner] * largest
    to_hidden *= hidden > 0
    to_taps = np.zeros_like(taps)
    rows, filters = np.nonzero(to_hidden)
    value = to_hidden[rows, filters]
    for j in range(WIDTH):
        seen = data[rows, best[rows, filters] * STRIDE + j]
        np.add.at(to_taps[j], (seen, filters), value)
    decay = DECAY
    return [
        to_taps + decay * taps,
        to_hidden.sum(axis=0) + decay * bias,
        x.T @ error + decay * dense,
        np.array([error.sum()], np.float32),
    ]


def remainder(id_column: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled rows that are not held out, by the order of a hash.

    Rows with a null id, label or text are left out, and texts of more than ``chars`` characters:
    these two bounds are the only ones, and training alone has them.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder("doc_id") != 0))
    picked = usable.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    some = picked.orderBy(F.xxhash64("id"), "label").limit(rows)
    texts = docs.where(F.length("text") <= chars).select(F.col("doc_id").alias("id"), "text")
    return some.join(texts, "id").orderBy(F.xxhash64("id"), "label", "text").limit(rows).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Network:
    sample = training_sample(docs, labels, rows, chars).collect()
    return train([r.text.encode("utf-8", "surrogatepass") for r in sample], [r.label for r in sample])


def score_documents(
    docs: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, score) of every row: the network over the whole text, chunks overlapping.

    A null text counts as empty, which is one chunk of zeros. Repeated rows give repeated rows, a
    null id stays null, an empty table gives no rows; no other column is read.
    """

    def make():
        worker_tool(None)
        return lambda ids, texts: ((i, network.score(t or b"")) for i, t in zip(ids, texts, strict=True))

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    return map_columns(picked, make, "id long, score double").withColumnRenamed("id", id_column)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), learned from the labels that are not held out."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
