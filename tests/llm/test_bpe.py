import hashlib
import io
import random
import zlib

import numpy as np
import pytest

from commitlens.llm import bpe, planes
from commitlens.llm.encoder import Encoder
from commitlens.llm.queries import vocabulary
from commitlens.session import shared_dir

PATH = vocabulary("word_bpe_49k.json")
SPACES = [" ", "\n", "\t", "\u00a0", "\u2000", "\u2028", "\x85", "\x1c", "  "]
BITS = [
    "the", "Thtion", "ing.", "it's", "I'LL", "3.14", "a1b2", "ÀÉñß", "e\u0301", "\u0301x", "ΣΑΣ", "İ", "ª²", "漢字", "🙂🙂",
    "\U0001d54f", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "###", "a\u00adb", "\u212a", "ﬁ", "''s", "\u0000",
]


def texts(n, seed):
    rng = random.Random(seed)
    shared = " ".join(rng.choice(BITS[:8]) + rng.choice(BITS[:8]) for _ in range(400))
    for _ in range(n):
        own = "".join(rng.choice(BITS) + rng.choice([*SPACES, "", ""]) for _ in range(rng.randrange(0, 300)))
        yield own + (shared[rng.randrange(500) :] if rng.random() < 0.6 else "") + own[:50]
    yield from ["", " ", "\n\n", "a" * 30_000, "<|endoftext|>" * 50, "ab\u0301 " * 9_000, "x " * 40_000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_words_and_chunks_agree_with_the_library(library):
    sample = list(texts(80, 3))
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in sample]
    raw = [t.encode() for t in sample]
    words = Encoder(PATH)
    assert words.by_word
    assert words.texts(raw) == want
    chunks = bpe.ChunkEncoder(words)
    assert chunks.encode(raw) == want
    assert chunks.encode(raw[::-1]) == want[::-1]
    table = bpe.Decoder(words)
    for ids in want:
        assert table.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_another_vocabulary_is_left_to_the_library():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    sample = list(texts(20, 4))
    words = Encoder(path)
    assert not words.by_word
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in sample]
    assert bpe.ChunkEncoder(words).encode([t.encode() for t in sample]) == want
    assert [bpe.Decoder(words).decode(w) for w in want] == [
        whole.decode(np.frombuffer(w, "<u4").tolist(), skip_special_tokens=False) for w in want
    ]


def test_cuts_depend_on_content_only():
    rng = random.Random(1)
    body = "".join(rng.choice("abc déf") for _ in range(20_000)).encode()
    a, b = bpe.cuts(b"x" * 77 + body), bpe.cuts("é".encode() * 40 + body)
    inner = {c - 77 for c in a if c > 77 + 64} & {c - 80 for c in b if c > 80 + 64}
    assert {c - 77 for c in a if c > 77 + 64} == inner and len(inner) > 5
    for text in (b"", b"a", "ü".encode() * 5000):
        if text:
            ends = bpe.cuts(text)
            assert ends[-1] == len(text) and all(text[:e].decode() is not None for e in ends)


ROWS = [(5, "One two", 1), (2, None, 2), (2, "zwei", 3), (9, "", 4), (None, "no id", 5), (5, "One two", 6), (1, "w " * 70_000, 7)]


def test_encode_documents(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids int")
    got = bpe.digests(bpe.encode_documents(docs, PATH, decoded=True)).collect()

    def row(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False).encode()
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()

    assert sorted(map(tuple, got), key=repr) == sorted((row(i, t) for i, t, _ in ROWS), key=repr)
    encoded = bpe.encode_documents(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    back = {r.doc_id: r.decoded for r in bpe.decode_documents(encoded.where("doc_id = 1"), PATH).collect()}
    assert back == {1: library.decode(library.encode("w " * 70_000, add_special_tokens=False).ids, skip_special_tokens=False)}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(empty, PATH).collect() == []


def test_plane_file_round_trip():
    rng = np.random.default_rng(2)
    out = io.BytesIO()
    writer = planes.PlaneWriter(out)
    docs = [(i if i % 7 else None, rng.integers(0, 1 << 32, n, dtype=np.uint32)) for i, n in enumerate([3, 0, 70_000, 1, 200_000, 0, 65_536, 5])]
    for i, ids in docs:
        writer.add(i, ids.astype("<u4").tobytes())
    n, total, size = writer.close()
    assert (n, total, size) == (8, sum(len(x) for _, x in docs), len(out.getvalue()))
    reader = planes.PlaneReader(io.BytesIO(out.getvalue()), size)
    back = list(reader.documents())
    assert [(i, np.frombuffer(raw, "<u4").tolist()) for i, _, raw in back] == [(i, x.tolist()) for i, x in docs]
    flat = np.concatenate([x for _, x in docs])
    for start, count in [(0, 1), (65_535, 2), (100_000, 131_072), (total - 1, 1), (5, 0)]:
        assert (reader.read(start, count) == flat[start : start + count]).all()


def test_ids_round_trip(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start int").repartition(3)
    got = sorted((tuple(r) for r in planes.ids_round_trip(docs, PATH, 2).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, t, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert planes.read_ids(planes.write_ids(empty, PATH, 2, shared_dir(spark))).collect() == []
