"""Fill-in-the-middle: texts cut in three and put together with their middle last."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.ragged import flat_bytes, slices

FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class Plan:
    """How texts are transformed.

    ``rate`` and ``spm_rate`` are percentages: of texts that are not left plain, and of those that get their suffix first.
    ``unit`` is what a cut falls between: ``token`` (a word with the white space before it, or white space at the
    end) or ``character`` (code points).
    """

    rate: int = 50
    spm_rate: int = 80
    unit: str = "token"
    seed: int = 42
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        signs = (self.prefix, self.suffix, self.middle)
        if self.unit not in ("token", "character") or not all(signs) or len(set(signs)) < 3:
            raise ValueError("a unit of token or character and three signs are needed")
        # A sign must be found at its first place behind any text: none may begin as one ends.
        for a in signs:
            for b in signs:
                if any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))) or (a != b and a in b):
                    raise ValueError("signs must not overlap")


class Characters:
    """Where characters lie among the bytes of UTF-8, from the exceptions alone.

    Only characters of several bytes are recorded: their positions, counted in characters, and the
    bytes they have in excess of one, summed up. Between two of them position and byte differ by a
    constant, so a search among the exceptions and one addition convert a cut; a text of ASCII has no exceptions.
    """

    def __init__(self, raw: np.ndarray):
        self.size = len(raw)
        leads = np.flatnonzero(raw >= 0xC0)
        excess = np.ones(len(leads), np.int64)
        excess += raw[leads] >= 0xE0
        excess += raw[leads] >= 0xF0
        self._excess = np.r_[0, np.cumsum(excess)]
        # Positions in characters: the byte of the lead less the excess before it.
        self._at = leads - self._excess[:-1]
        # The byte behind each exception.
        self._behind = leads + excess + 1
        self.length = self.size - int(self._excess[-1])

    def to_bytes(self, characters: np.ndarray) -> np.ndarray:
        """The byte each character starts at; the length gives the end."""
        return characters + self._excess[np.searchsorted(self._at, characters, "left")]

    def to_characters(self, places: np.ndarray) -> np.ndarray:
        """The characters before each byte that starts one; the size in bytes gives the length."""
        return places - self._excess[np.searchsorted(self._behind, places, "right")]


def _token_ends(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of flat texts end, and where each text's tokens start among these."""
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    last = np.zeros(len(raw), bool)
    last[offsets[1:][np.diff(offsets) > 0] - 1] = True
    follows = np.ones(len(raw), bool)
    follows[:-1] = space[1:]
    # A word ends before white space; whatever ends with the text is a token as well.
    ends = np.flatnonzero((~space & follows) | last) + 1
    return ends, np.searchsorted(ends, offsets, "right")


def _rearranged(raw: np.ndarray, offsets: np.ndarray, cuts: tuple[np.ndarray, np.ndarray], form: np.ndarray, plan: Plan) -> pa.Array:
    data, out = raw.tobytes(), []
    p, s, m = (x.encode() for x in (plan.prefix, plan.suffix, plan.middle))
    for kind, a, x, y, b in zip(form.tolist(), offsets[:-1].tolist(), cuts[0].tolist(), cuts[1].tolist(), offsets[1:].tolist(), strict=True):
        if kind == 0:
            out.append(data[a:b])
        elif kind == 1:
            out.append(b"".join((p, data[a:x], s, data[y:b], m, data[x:y])))
        else:
            out.append(b"".join((s, data[y:b], p, data[a:x], m, data[x:y])))
    return pa.array(out, pa.binary())


def _draws(id_column: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, plan: Plan = Plan(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each whole text rearranged or left plain.

    ``n`` is the number of units. Two cuts are drawn from the digest of seed and id, so equal
    ids are cut by equal draws and every run gives the same. Cuts fall on bytes (tokens) or characters, and ``Characters`` converts
    one into the other for a whole batch at once. Texts that are empty, hold a sign, or
    are not drawn stay plain, with null lengths. No shuffle; a text is in one task with its batch.

    A null text counts as empty; a row without an id has no draws and stays plain; repeated rows give equal rows; long
    texts are worked on whole; an empty table gives no rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                raw, offsets = flat_bytes(part.column(1))
                signs = part.column(2).to_numpy(zero_copy_only=False)
                h = [part.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(3, 7)]
                known = ~part.column(0).is_null().to_numpy(zero_copy_only=False)
                chars = Characters(raw)
                text_at = chars.to_characters(offsets)
                if plan.unit == "token":
                    ends, starts = _token_ends(raw, offsets)
                    n = np.diff(starts)
                else:
                    n = np.diff(text_at)
                one, two = h[0] % (n + 1), h[1] % (n + 1)
                units = np.minimum(one, two), np.maximum(one, two)
                if plan.unit == "token":
                    ends = np.r_[ends, 0]
                    places = tuple(np.where(u > 0, ends[starts[:-1] + u - 1], offsets[:-1]) for u in units)
                    at = tuple(chars.to_characters(x) for x in places)
                else:
                    at = tuple(text_at[:-1] + u for u in units)
                    places = tuple(chars.to_bytes(x) for x in at)
                plain = ~known | signs | (np.diff(offsets) == 0) | (h[2] % 100 >= plan.rate)
                form = np.where(plain, 0, np.where(h[3] % 100 < plan.spm_rate, 2, 1))
                output = _rearranged(raw, offsets, places, form, plan)
                names = pa.array(np.array(FORMS, dtype=object)[form], pa.string())
                lengths = [pa.array(x.astype(np.int64), pa.int64(), mask=plain) for x in (at[0] - text_at[:-1], at[1] - at[0])]
                columns = [part.column(0), pa.array(n.astype(np.int64)), names, *lengths, output.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    held = F.lit(False)
    for sign in (plan.prefix, plan.suffix, plan.middle):
        held = held | F.contains(text, F.lit(sign))
    draws = [d.alias(f"h{i}") for i, d in enumerate(_draws(id_column, plan.seed))]
    picked = docs.select(F.col(id_column).cast("long").alias("id"), text.cast("binary").alias("text"), held.alias("held"), *draws)
    made = picked.mapInArrow(run, "id long, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_column)


def restored(plan: Plan = Plan(), output: str = "output", form: str = "form") -> Column:
    """The text an output was made of, from the output and its form alone."""

    def around(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands behind ``first``, behind ``second`` and behind the last sign."""
        rest = F.substr(F.col(output), F.lit(len(first) + 1))
        a = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(a) + len(second) + 1)
        b = F.substring_index(rest, plan.middle, 1)
        return a, b, F.substr(rest, F.length(b) + len(plan.middle) + 1)

    p, s, m = around(plan.prefix, plan.suffix)
    s2, p2, m2 = around(plan.suffix, plan.prefix)
    f = F.col(form)
    return F.when(f == "psm", F.concat(p, m, s)).when(f == "spm", F.concat(p2, m2, s2)).otherwise(F.col(output))


def digests(made: DataFrame, plan: Plan = Plan(), id_column: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of ``transform``."""

    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    return made.select(
        id_column, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(plan)).alias("restored_sha256")
    )
