import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from commitlens.llm import pieces
from commitlens.llm.merges import Merges
from commitlens.llm.pieces import PieceCoder
from commitlens.llm.queries import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


def one_by_one(symbols, pairs):
    """The merges of a word in the order the libraries make them: lowest rank first, then leftmost."""
    word = list(symbols)
    while True:
        found = [(pairs[p][0], i) for i, p in enumerate(zip(word, word[1:], strict=False)) if p in pairs]
        if not found:
            return word
        _, i = min(found)
        word[i : i + 2] = [pairs[word[i], word[i + 1]][1]]


@pytest.mark.parametrize("seed", range(12))
def test_rounds_make_the_merges_of_a_queue(seed):
    """Random pair tables, with ranks that tie and that fall below those of their parts."""
    rng = random.Random(seed)
    size, pairs = 4, {}
    for _ in range(60):
        a, b = rng.randrange(size), rng.randrange(size)
        if (a, b) not in pairs:
            pairs[a, b] = (rng.randrange(8 if seed % 2 else 200), size)
            size += 1
    table = Merges(*np.array([(a, b, r, m) for (a, b), (r, m) in pairs.items()], np.int64).T)
    words = [[rng.choice([0, 1, 2, 3, 3, -1]) for _ in range(rng.randrange(1, 30))] for _ in range(200)]
    words += [[0] * n for n in range(1, 20)] + [[rng.randrange(4) for _ in range(4_000)], [1] * 5_000]
    flat, offsets = np.concatenate(words), np.r_[0, np.cumsum([len(w) for w in words])]
    made, first = table.run(flat, offsets)
    at = np.searchsorted(first, offsets)
    pairs = {k: v for k, v in pairs.items() if -1 not in k}
    got = [made[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)]
    assert got[:-2] == [one_by_one(w, pairs) for w in words[:-2]]
    # Long words: equal to the way that finishes what rounds do not, too.
    out = np.full(len(flat), -2, np.int64)
    table._one_by_one(flat.astype(np.int32), np.arange(len(flat)), np.repeat(np.arange(len(words)), np.diff(offsets)), out)
    assert np.array_equal(out[out != -2], made) and np.array_equal(np.flatnonzero(out != -2), first)


def odd_texts():
    rng = random.Random(5)
    yield from ["", " ", "  ", "a", " a", "▁a", "▁ ▁", "\0", "a  b ", "日本語テキスト", "🙂" * 50, " " * 500, "a" * 3000, "=" * 700 + " " * 300, "\n" * 100]
    yield from ["<s></s><unk><0x0A>", None, "́x", "x\r\n\ty", "é" * 999, "".join(rng.choice("abcdefgh -=_. \n▁é漢") for _ in range(20_000))]
    for _ in range(400):
        yield "".join(rng.choice(" ab=-▁*#/\\t\n漢é") for _ in range(rng.randrange(60)))
    for _ in range(60):
        yield " ".join(rng.choice(["the", "Theory", "ing.", "naïve", "größe", "код", "the  end"]) + rng.choice(["", ",", "s"]) for _ in range(rng.randrange(400)))


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(PATH)


def test_ids_and_texts_are_the_librarys(coder):
    sample = list(odd_texts())
    for end in (True, False):
        flat, at = coder.encode(pa.array(sample, pa.string()), end)
        want = [coder.library.encode(t or "", add_eos=end) for t in sample]
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
        assert coder.decode(flat, at).to_pylist() == [coder.library.decode(w) for w in want]


def test_decoding_ids_from_elsewhere(coder):
    rng = random.Random(6)
    rows = [[rng.randrange(32_000) for _ in range(rng.randrange(12))] for _ in range(300)] + [[0], [1, 1, 264], [2], [195 + 3], [35, 264]]
    rows += [[28705, 28705, 264], [1, 28705], []]
    for group in (rows, *[[r] for r in rows]):
        flat = np.array([i for r in group for i in r], np.int32)
        at = np.r_[0, np.cumsum([len(r) for r in group])].astype(np.int64)
        assert coder.decode(flat, at).to_pylist() == [coder.library.decode(r) for r in group]
    with pytest.raises(ValueError, match="an id the model"):
        coder.decode(np.array([32_000], np.int32), np.array([0, 1]))


ROWS = [(5, "One two", 1), (2, None, 2), (2, "zwei", 3), (9, "", 4), (None, "no id", 5), (5, "One two", 6), (1, "w " * 70_000, 7)]


def test_documents(spark, coder):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids long").repartition(2)
    made = pieces.encode_documents(docs, PATH, decoded=True)
    want = [(i, coder.library.encode(t or "", add_eos=True)) for i, t, _ in ROWS]
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]), str(r[1][:9]))
    assert sorted(((r.doc_id, r.ids) for r in made.collect()), key=key) == sorted(want, key=key)
    back = pieces.decode_documents(made.select("doc_id", "ids"), PATH)
    assert sorted(back.collect(), key=repr) == sorted(made.select("doc_id", "decoded").collect(), key=repr)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digests(made).collect()}
    assert got == {
        (i, len(w), hashlib.sha256(" ".join(map(str, w)).encode()).hexdigest(), hashlib.sha256(coder.library.decode(w).encode()).hexdigest())
        for i, w in want
    }
    assert pieces.digests(pieces.encode_documents(docs.limit(0), PATH, decoded=True)).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [264, None, 287])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, pieces.decode_documents(nulls, PATH).collect())) == [(1, ""), (2, coder.library.decode([264, 287]))]
