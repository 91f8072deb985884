"""Encoding and decoding whole texts, with content-defined chunks encoded once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import Memo, map_columns, no_cycles, worker_tool
from commitlens.llm.encoder import END_OF_WORD, Encoder, encoder

# Bytes the rolling hash looks back on, and the bits of it that must be zero to cut.
_WINDOW, _CUT_BITS = 32, 10
# What a worker remembers in each of two generations: chunks, about 2 kB each, and words beside them.
CHUNKS_KEPT, WORDS_KEPT = 10_000, 150_000
_GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(text: bytes) -> list[int]:
    """Where content-defined chunks of a UTF-8 text end, the text's end included.

    A gear hash rolls over the last 32 bytes; all positions are computed together by doubling the
    window. A cut depends on those bytes only, so equal passages are cut alike wherever they stand.
    A character is never cut.
    """
    data = np.frombuffer(text, np.uint8)
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    at = np.flatnonzero(h[_WINDOW - 1 : -1] >> np.uint32(32 - _CUT_BITS) == 0) + _WINDOW
    at = at[data[at] & 0xC0 != 0x80]
    return [*at.tolist(), len(text)]


class Chunk(NamedTuple):
    """A chunk's ids but for the words its edges may cut: ``head`` up to and ``tail`` after them.

    Without white space the whole chunk is its ``head`` and ``ids`` is None.
    """

    head: bytes
    ids: bytes | None
    tail: bytes


class ChunkEncoder:
    def __init__(self, words: Encoder):
        self.words = words
        self._texts: dict[bytes, bytes] = {}
        self.chunks = Memo(self._encode_chunks, CHUNKS_KEPT)

    def _encode_chunks(self, keys: list[bytes]) -> list[Chunk]:
        bounds, inner = [], []
        for key in keys:
            text = self._texts[key]
            first = END_OF_WORD.search(text)
            if first is None:
                bounds.append(None)
                continue
            start = first.start()
            end = len(text) - (0 if text[-1:].isspace() else len(text.rsplit(None, 1)[-1]))
            bounds.append((start, end))
            inner.append(text[start:end])
        made = iter(self.words.texts(inner))
        return [
            Chunk(t, None, b"") if b is None else Chunk(t[: b[0]], next(made), t[b[1] :])
            for t, b in zip((self._texts[k] for k in keys), bounds, strict=True)
        ]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of whole texts: chunks by their digest, then the joins repaired.

        At a join the last word of one side and the first of the other may be one word, which
        alone can disagree with a whole encoding: white space on either side of it parts tokens
        under the vocabulary's rules. So it is encoded anew from white space to white space, however many
        chunks lie between, and from there on both sides agree with the whole exactly.
        """
        if not self.words.by_word:
            return self.words.texts(texts)
        with no_cycles():
            return self._by_chunk(texts)

    def _by_chunk(self, texts: list[bytes | None]) -> list[bytes]:
        split: list[list[bytes]] = []
        for text in texts:
            keys, at = [], 0
            for end in cuts(text) if text else ():
                piece = text[at:end]
                key = xxhash.xxh3_128_digest(piece)
                self._texts[key] = piece
                keys.append(key)
                at = end
            split.append(keys)
        found = iter(self.chunks.look([k for keys in split for k in keys]))
        self._texts.clear()
        plans: list[list[bytes | None]] = []
        torn: list[bytes] = []
        for keys in split:
            plan: list[bytes | None] = []
            open_word = b""
            for _ in keys:
                chunk = next(found)
                open_word += chunk.head
                if chunk.ids is not None:
                    if open_word:
                        torn.append(open_word)
                        plan.append(None)
                    plan.append(chunk.ids)
                    open_word = chunk.tail
            if open_word:
                torn.append(open_word)
                plan.append(None)
            plans.append(plan)
        mended = iter(self.words.words.look(torn))
        return [b"".join([next(mended) if p is None else p for p in plan]) for plan in plans]


class Decoder:
    """Text of ids, as the library's decode without skipping special tokens.

    A vocabulary without a decoder step puts one space between its tokens; then that is done here
    from a table. Any other is left to the library.
    """

    def __init__(self, words: Encoder):
        self.full = words.full
        self.joined = self.full.decoder is None
        size = self.full.get_vocab_size(with_added_tokens=True)
        known = [self.full.id_to_token(i) for i in range(size)]
        self.tokens = np.array([t or "" for t in known], dtype=object)
        self.all_known = None not in known

    def decode(self, raw: bytes) -> str:
        ids = np.frombuffer(raw, "<u4")
        if not self.joined or not self.all_known:
            return self.full.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(self.tokens[ids].tolist())


def _tools(path: str) -> tuple[ChunkEncoder, Decoder]:
    def make():
        words = encoder(path, WORDS_KEPT)
        return ChunkEncoder(words), Decoder(words)

    return worker_tool(("bpe", path), make)


def encode_documents(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, ids) or (id, ids, decoded): each row's ids, little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a tokenizers file that every executor has. Ids are exactly those of
    the library without special tokens added. Chunks that documents share are encoded once per
    Python worker, while it remembers them (``CHUNKS_KEPT``); no text is shuffled. A null or empty text has no
    ids and decodes to the empty text, repeated rows give repeated rows, a null id stays null and
    an empty table gives no rows. Other columns are not read.
    """
    schema = "id long, ids binary" + ", decoded string" * decoded

    def make():
        chunks, table = _tools(vocabulary)

        def work(ids, texts):
            raw = chunks.encode(texts)
            return zip(ids, raw, map(table.decode, raw), strict=True) if decoded else zip(ids, raw, strict=True)

        return work

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    return map_columns(picked, make, schema).withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded): the text of each row's ids; null ids decode to the empty text."""

    def make():
        _, table = _tools(vocabulary)
        return lambda ids, raw: ((i, table.decode(r or b"")) for i, r in zip(ids, raw, strict=True))

    picked = encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids_column).alias("ids"))
    return map_columns(picked, make, "id long, decoded string").withColumnRenamed("id", id_column)


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``encode_documents`` with decoded texts."""
    return encoded.select(
        id_column,
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
