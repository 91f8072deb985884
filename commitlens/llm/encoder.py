"""Token ids by the tokenizers library, word by word where that is exact."""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from commitlens.llm.common import Memo, no_cycles
from commitlens.llm.merges import Merges
from commitlens.llm.ragged import as_list, cut, flat_bytes, gather, offsets_of

END_OF_WORD = re.compile(rb"[\x20\x09-\x0D]")

# The steps of a vocabulary file under which white space always parts two tokens and
# is itself dropped, so that a text's ids are those of its words one after the other.
NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# The same pattern for lower-cased Latin-1, where NFC changes nothing and letters, numbers and
# white space are these.
_LETTERS, _NUMBERS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\x09-\\x0D\\x20\\x85\\xA0"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile(r"(?:(?!<\|)[\x00-\xFF])*")

# Words and parts of words whose ids a worker remembers.
WORDS_KEPT = 250_000
# Bytes of text whose words are in hand at one time, or one longer text.
BYTES_AT_ONCE = 4 << 20


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable Latin-1, else one from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _merges_plainly(model: dict) -> bool:
    """Whether words merge byte by byte, with a mark at the last one, and nothing else."""
    end = model.get("end_of_word_suffix")
    known = model.get("vocab") or {}
    return (
        model.get("type", "BPE") == "BPE"
        and bool(end)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and all(c in known and c + end in known for c in _byte_letters())
    )


class Encoder:
    """Ids of words or texts, as bytes: little-endian unsigned 32-bit integers.

    What the library does to a word before merging (NFC, lower case, splitting) is repeated here
    for Latin-1 words only, whose parts then merge all together (``Merges``); any other word, and
    one that may hold a special token, goes to the library whole.
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        steps = (stated.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (stated.get("normalizer") or {}).get("normalizers") == NORMALIZER
            and steps[0].get("pattern") == {"Regex": PATTERN}
            and steps[0].get("behavior") == "Removed"
            and [s.get("type") for s in steps[1:]] == ["ByteLevel"]
            and not steps[1].get("add_prefix_space")
            and _merges_plainly(stated["model"])
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in stated["added_tokens"])
        )
        self.words = Memo(self._encode_words, kept)
        if self.by_word:
            model = stated["model"]
            known: dict[str, int] = model["vocab"]
            pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
            made = [(known[a], known[b], rank, known[a + b]) for rank, (a, b) in enumerate(pairs)]
            self._merges = Merges(*np.array(made, np.int64).reshape(-1, 4).T)
            shown = _byte_letters()
            self._inner = np.array([known[c] for c in shown], np.int32)
            self._last = np.array([known[c + model["end_of_word_suffix"]] for c in shown], np.int32)

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the parts and their offsets."""
        raw, offsets = flat_bytes(parts)
        symbols = self._inner[raw]
        symbols[offsets[1:] - 1] = self._last[raw[offsets[1:] - 1]]
        ids, first = self._merges.run(symbols, offsets)
        return ids.astype("<u4"), np.searchsorted(first, offsets)

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8") for w in words]
        plain = _PLAIN.fullmatch
        split = [_LATIN.findall(t.lower()) if plain(t) else () for t in texts]
        coded = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        ids, offsets = self._encode_parts(coded.dictionary)
        flat, places = gather(ids, offsets, coded.indices.to_numpy(zero_copy_only=False))
        made = cut(flat.tobytes(), 4 * places[offsets_of(np.fromiter(map(len, split), np.int64, len(split)))])
        for i, (text, parts) in enumerate(zip(texts, split, strict=True)):
            if not parts:
                made[i] = self.whole(text)
        return made

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of whole UTF-8 texts; a null text has none.

        All words of all texts are numbered by Arrow, each distinct word is looked up once, and the
        ids of every place are gathered from those.
        """
        if not self.by_word:
            return [self.whole((t or b"").decode("utf-8")) for t in texts]
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held < BYTES_AT_ONCE):
                held += len(texts[end] or b"")
                end += 1
            with no_cycles():
                out += self._slice(texts[at:end])
            at = end
        return out

    def _slice(self, texts: list[bytes | None]) -> list[bytes]:
        whole = pa.array([t or b"" for t in texts], pa.large_binary()).cast(pa.large_string())
        words = pc.ascii_split_whitespace(whole)
        coded = words.flatten().dictionary_encode()
        found = self.words.look(as_list(coded.dictionary))
        ids = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, ends = gather(ids, offsets_of(lengths), coded.indices.to_numpy(zero_copy_only=False))
        return cut(flat.tobytes(), 4 * ends[words.offsets.to_numpy()])


def encoder(path: str, kept: int = WORDS_KEPT) -> Encoder:
    import os

    # The tasks are the parallel part.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, kept)
