"""Quality rules on words, lines and what a public vocabulary makes of a text."""

from __future__ import annotations

import unicodedata
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import Memo, fresh, map_columns, with_struct, worker_tool

# Base rules: fewest words, words of a repeated window, and their largest share in percent.
LEAST_WORDS, WINDOW, REPEATED_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
_WORDS_KEPT = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long,"
    " chars_per_token double, fallback_share double, token_entropy double, symbol_share double, script string,"
    " base_failed boolean, kept boolean"
)


class Band(NamedTuple):
    """What a text of one script may measure. Entropy counts from ``entropy_from`` tokens on."""

    least_chars_per_token: float
    most_chars_per_token: float
    most_fallback_share: float
    least_entropy: float
    most_symbol_share: float = 0.10
    entropy_from: int = 200


# A 32 000-piece vocabulary made mostly from text in Latin letters: prose in those takes two to five
# letters a token and hardly any bytes, Cyrillic and Greek about two, and scripts it knows little of
# go to bytes by rights. Low entropy is one token over and over.
BANDS = {
    "latin": Band(1.3, 8.0, 0.25, 3.0),
    "cyrillic": Band(1.1, 8.0, 0.35, 3.0),
    "greek": Band(0.7, 8.0, 0.50, 3.0),
    "cjk": Band(0.3, 4.0, 0.95, 3.0),
    "other": Band(0.2, 8.0, 1.00, 2.0),
}


@lru_cache(maxsize=65_536)
def _script_of(char: str) -> str | None:
    if not char.isalpha():
        return None
    name = unicodedata.name(char, "")
    for script, starts in (
        ("latin", ("LATIN", "FULLWIDTH LATIN", "FEMININE", "MASCULINE", "MICRO")),
        ("cyrillic", ("CYRILLIC",)),
        ("greek", ("GREEK",)),
        ("cjk", ("CJK", "HIRAGANA", "KATAKANA", "HANGUL")),
    ):
        if name.startswith(starts):
            return script
    return "other"


def script(text: str) -> str:
    """The script most letters belong to; Latin for a text without letters, ties in the bands' order."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = dict.fromkeys(BANDS, 0)
    for code, n in zip(*(x.tolist() for x in np.unique(codes, return_counts=True)), strict=True):
        kind = _script_of(chr(code))
        if kind:
            counts[kind] += n
    return max(counts, key=counts.get)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, the first time included."""
    if len(words) <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    power, size = _MIX, 1
    rolled = h * _MIX
    while size < window:
        step = min(size, window - size)
        # Window of size + step: the first ``size`` words, then the ``size`` ending step later.
        rolled = rolled[: len(rolled) - step] * power + rolled[step:]
        power, size = power * _MIX, size + step
    order = np.sort(rolled)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(rolled, twice))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


class Rules:
    """Measures and verdict of a text, by one sentencepiece vocabulary and a band per script."""

    def __init__(self, path: str, bands: dict[str, Band]):
        from sentencepiece import SentencePieceProcessor

        self._pieces = SentencePieceProcessor(model_file=path)
        size = len(self._pieces)
        self._is_byte = np.array([self._pieces.IsByte(i) for i in range(size)])
        bare = [self._pieces.IdToPiece(i).lstrip("\u2581") for i in range(size)]
        self._is_symbol = np.array([bool(p) and not p.strip(SYMBOLS) for p in bare])
        self._bands = bands
        self.words = Memo(self._encode, _WORDS_KEPT)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        made = self._pieces.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        return [array("I", ids).tobytes() for ids in made]

    def tokens(self, words: list[bytes]) -> tuple[int, int, int, float]:
        """Tokens of the words one by one, how many are single bytes or symbols, their entropy in bits."""
        ids = np.frombuffer(b"".join(self.words.look(words)), "<u4")
        if not len(ids):
            return 0, 0, 0, 0.0
        ids, n = np.unique(ids, return_counts=True)
        share = n / n.sum()
        bits = max(0.0, float(-(share * np.log2(share)).sum()))
        return int(n.sum()), int(n[self._is_byte[ids]].sum()), int(n[self._is_symbol[ids]].sum()), bits

    def measure(self, text: str | None) -> tuple:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
        symbols = sum(map(text.count, SYMBOLS))
        lines = raw.split(b"\n")
        repeated_lines = 0
        if len(set(lines)) < len(lines):
            filled = [line for line in lines if line.split(None, 1)]
            repeated_lines = len(filled) - len(set(filled))
        repeats = repeated_words(words)
        failed = len(words) < LEAST_WORDS or 100 * repeats > REPEATED_PERCENT * len(words)
        tokens, fallback, marks, entropy = self.tokens(words)
        kind = script(text)
        per_token = chars / tokens if tokens else 0.0
        share = fallback / tokens if tokens else 0.0
        symbol_share = marks / tokens if tokens else 0.0
        band = self._bands[kind]
        good = (
            band.least_chars_per_token <= per_token <= band.most_chars_per_token
            and share <= band.most_fallback_share
            and symbol_share <= band.most_symbol_share
            and (tokens < band.entropy_from or entropy >= band.least_entropy)
        )
        return (
            len(words), chars, symbols, repeated_lines, repeats, tokens, per_token, share, entropy,
            symbol_share, kind, failed, good and not failed,
        )


def _rules(path: str, bands: tuple) -> Rules:
    return worker_tool(("fertility", path, bands), lambda: Rules(path, dict(bands)))


def quality_measures(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", bands: dict[str, Band] | None = None
) -> DataFrame:
    """(id, measures, base_failed, kept), one row per row of ``docs``, in one pass without a shuffle.

    A null text counts as empty: it has no words and fails. Repeated rows give repeated rows, a
    null id stays null, an empty table gives no rows; other columns are not read. ``vocabulary`` is
    the path of a sentencepiece model with byte fallback that every executor has.
    """
    key = tuple((bands or BANDS).items())

    def make():
        rules = _rules(vocabulary, key)
        return lambda ids, texts: ((i, *rules.measure(t)) for i, t in zip(ids, texts, strict=True))

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return map_columns(picked, make, f"id long, {MEASURES}").withColumnRenamed("id", id_column)


def keep_good(
    docs: DataFrame, vocabulary: str, text_column: str = "text", bands: dict[str, Band] | None = None
) -> DataFrame:
    """The rows of ``docs`` whose text passes the rules, all columns as they are."""
    key = tuple((bands or BANDS).items())
    verdict = fresh(docs, "quality")

    def make():
        rules = _rules(vocabulary, key)
        return lambda text: (rules.measure(text)[-1],)

    judged = with_struct(docs, verdict, "kept boolean", make, text_column)
    return judged.where(F.col(f"{verdict}.kept")).drop(verdict)
