"""SentencePiece encoding and decoding of whole texts, many words at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import Memo, no_cycles, worker_tool
from commitlens.llm.merges import Merges
from commitlens.llm.ragged import as_binary, as_list, cut, flat_bytes, gather, offsets_of, slices

# Fixed values of the model format: the kinds of pieces and of models, and the sign for a space.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE, _BPE, _SPACE = 1, 2, 3, 6, 2, "▁"
_SIGN = _SPACE.encode()
# Words whose ids a worker remembers in each of two generations.
WORDS_KEPT = 200_000


class PieceCoder:
    """Ids of texts and texts of ids under a model of merged pieces with byte fallback.

    A text is cut into words before each run of spaces, and a word wherever two neighbouring
    characters stand together in no piece of the vocabulary: no merge can ever cross such a place, so
    words merge each by itself and exactly as they would inside the text. Distinct words of a
    batch merge together, in rounds (``Merges``).
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = {p.type for p in model.pieces}
        spec = model.trainer_spec
        if spec.model_type != _BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("a model of merged pieces with byte fallback and without user-defined pieces is needed")
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or not normal.add_dummy_prefix:
            raise ValueError("a model that leaves texts as they are but for the leading space is needed")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end_id = self.library.eos_id()
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        scores = {p: model.pieces[i].score for p, i in pieces.items()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # Characters that are no piece of their own still merge.
        symbols = dict(pieces)
        for c in sorted({c for p in pieces for c in p}):
            symbols.setdefault(c, len(model.pieces) + len(symbols))
        pairs, together = [], set()
        for piece, number in pieces.items():
            for i in range(1, len(piece)):
                together.add((ord(piece[i - 1]), ord(piece[i])))
                a, b = symbols.get(piece[:i]), symbols.get(piece[i:])
                if a is not None and b is not None:
                    pairs.append((a, b, order[scores[piece]], number))
        self.merges = Merges(*np.array(pairs, np.int64).reshape(-1, 4).T)
        near = np.array(sorted(together), np.int64).reshape(-1, 2)
        self._near = Merges(near[:, 0], near[:, 1], np.zeros(len(near)), near[:, 0])
        self._symbol = np.full(0x110000, -1, np.int32)
        for c, number in symbols.items():
            if len(c) == 1:
                self._symbol[ord(c)] = number
        self._symbol[ord(" ")] = self._symbol[ord(_SPACE)]
        self._pieces = len(model.pieces)
        self._bytes = np.zeros(256, np.int32)
        shown: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                self._bytes[int(p.piece[1:-1], 16)] = i
                shown.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                shown.append(p.piece.replace(_SPACE, " ").encode() if p.type == _NORMAL else b"")
        self._shown = np.frombuffer(b"".join(shown), np.uint8)
        self._shown_at = offsets_of(np.array([len(s) for s in shown]))
        self._silent = np.array([p.type == _CONTROL for p in model.pieces])
        self._odd = np.array([p.type == _UNKNOWN for p in model.pieces])
        self._spaced = np.array([p.type == _NORMAL and p.piece.startswith(_SPACE) for p in model.pieces])
        self.words = Memo(self._encode_words, kept)

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids, little-endian 32 bits each, of words that each begin as in a text."""
        raw = b"".join(words)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        leads = np.cumsum(np.r_[0, np.frombuffer(raw, np.uint8) & 0xC0 != 0x80])
        word_at = leads[offsets_of(np.fromiter(map(len, words), np.int64, len(words)))]
        points[points == ord(" ")] = ord(_SPACE)
        apart = np.ones(len(points) + 1, bool)
        if len(points) > 1:
            apart[1:-1] = self._near.look(points[:-1], points[1:])[1] < 0
        apart[word_at] = True
        made, first = self.merges.run(self._symbol[points], np.flatnonzero(apart))
        known = (made >= 0) & (made < self._pieces)
        ids, sizes = made.astype("<i4"), np.ones(len(made), np.int64)
        if not known.all():
            lost = np.flatnonzero(~known)
            spelled = ["".join(map(chr, points[a:b])).encode() for a, b in zip(first[lost], np.r_[first, len(points)][lost + 1], strict=True)]
            sizes[lost] = [len(s) for s in spelled]
            ids = np.repeat(ids, sizes)
            at = offsets_of(sizes)[:-1][lost]
            ids[np.concatenate([np.arange(a, a + len(s)) for a, s in zip(at, spelled, strict=True)])] = self._bytes[np.frombuffer(b"".join(spelled), np.uint8)]
        edges = 4 * offsets_of(sizes)[np.searchsorted(first, word_at)]
        return cut(ids.tobytes(), edges)

    def encode(self, texts: pa.Array, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and their offsets; with ``end`` each text's end id behind its own."""
        raw, offsets = flat_bytes(texts)
        sizes = np.diff(offsets)
        # The leading space of every text that is not empty.
        filled = sizes > 0
        at = offsets_of(sizes + filled)
        spaced = np.full(at[-1], ord(" "), np.uint8)
        own = np.ones(at[-1], bool)
        own[at[:-1][filled]] = False
        spaced[own] = raw
        gap = spaced == ord(" ")
        begins = gap.copy()
        begins[1:] &= ~gap[:-1]
        # The sign for a space may stand in a text itself, and joins the run.
        signs = np.flatnonzero(spaced[:-3] == _SIGN[0])
        signs = signs[(spaced[signs + 1] == _SIGN[1]) & (spaced[signs + 2] == _SIGN[2])]
        begins[signs + 3] = False
        begins[at[:-1][filled]] = True
        begins = np.flatnonzero(begins)
        ends = np.r_[begins, at[-1]]
        coded = as_binary(spaced, ends).dictionary_encode()
        with no_cycles():
            found = self.words.look(as_list(coded.dictionary))
        ids = np.frombuffer(b"".join(found), "<i4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, places = gather(ids, offsets_of(lengths), coded.indices.to_numpy(zero_copy_only=False))
        text_at = places[np.searchsorted(begins, at)]
        if not end:
            return flat, text_at
        ended = np.full(len(flat) + len(sizes), self.end_id, "<i4")
        with_end = text_at + np.arange(len(text_at))
        own = np.ones(len(ended), bool)
        own[with_end[1:] - 1] = False
        ended[own] = flat
        return ended, with_end

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of flat ids, as the library's decode gives them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self._pieces):
            raise ValueError("an id the model does not have")
        shown, at = gather(self._shown, self._shown_at, ids)
        text_at = at[offsets]
        # The first piece that is not a control sign loses its space.
        loud = np.r_[np.flatnonzero(~self._silent[ids]), len(ids)]
        first = loud[np.searchsorted(loud, offsets[:-1])]
        leading = first[(first < offsets[1:]) & (offsets[1:] > offsets[:-1])]
        leading = at[leading[self._spaced[ids[leading]]]]
        kept = np.ones(len(shown), bool)
        kept[leading] = False
        text_at = text_at - np.searchsorted(leading, text_at)
        texts = as_binary(shown[kept], text_at)
        try:
            if self._odd[ids].any():
                raise pa.ArrowInvalid("an unknown id")
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:
            # Unknown ids and bytes that are no text come from elsewhere than ``encode``.
            runs = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            return pa.array([self.library.decode(ids[a:b].tolist()) for a, b in runs], pa.large_string())


def _coder(path: str) -> PieceCoder:
    return worker_tool(("pieces", path), lambda: PieceCoder(path))


def _listed(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


def encode_documents(
    docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", end: bool = True, decoded: bool = False
) -> DataFrame:
    """(id, ids) or (id, ids, decoded): the ids of each row's whole text as an array of int.

    ``model`` is the path of a model file that every executor has. Ids are those of the library without sampling, and with its end id
    behind them if ``end``; ``decoded`` is the text of these ids. Only distinct words are merged, by a worker that remembers
    ``WORDS_KEPT`` of them; no text is shuffled. A null or empty text has no id but the end id and decodes
    to the empty text; a long text is worked on whole; repeated rows give repeated rows, a null id stays null, and an empty table gives no rows.
    Other columns, of whatever names, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            for part in slices(batch, 1):
                flat, offsets = coder.encode(part.column(1), end)
                columns = [part.column(0), _listed(flat, offsets)]
                if decoded:
                    columns.append(coder.decode(flat, offsets).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][: len(columns)])

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    made = picked.mapInArrow(run, "id long, ids array<int>" + ", decoded string" * decoded)
    return made.withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, model: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded): the text of each row's ids; null or empty ids give the empty text, null elements count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            sizes = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
            texts = coder.decode(flat, offsets_of(sizes)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["id", "decoded"])

    ids = F.array_compact(F.col(ids_column).cast("array<int>")).alias("ids")
    picked = encoded.select(F.col(id_column).cast("long").alias("id"), ids)
    return picked.mapInArrow(run, "id long, decoded string").withColumnRenamed("id", id_column)


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``encode_documents`` with decoded texts."""
    return encoded.select(
        id_column,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
