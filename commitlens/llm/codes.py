"""Compressing vectors to codes: parts assigned to codebook entries by way of a trie of distinct parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import fresh
from commitlens.session import written

# Components stay within this, so that squares and sums of them are exact in 64 bits.
LARGEST = 1 << 26
# Vectors whose tries a task holds at one time, and the leaves below a prefix that are walked as one.
VECTORS_AT_ONCE, LEAVES_AT_ONCE = 1 << 15, 1 << 12


@dataclass(frozen=True)
class Codes:
    """The coded vectors and the codebook they refer to: part, entry, position within the part."""

    vectors: DataFrame
    codebook: np.ndarray


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, the place of each given row among them, and how often each occurs."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)] if len(parts) else np.zeros(0, bool)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place, np.bincount(place, minlength=int(new.sum()))


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct sorted parts the nearest entry, ties to the lower one, and its squared distance.

    The rows are the leaves of a trie whose levels are the dimensions. It is walked depth first: a node
    holds one vector, the squared distances to all entries summed over the dimensions of its
    prefix, and hands it to its children, so a prefix that many parts share is summed up once. From
    a node with few leaves on, a level's children are computed together.
    """
    n, width = parts.shape
    best, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    spread = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    # Narrow integers where the largest sum fits them.
    kind = np.int32 if width * (2 * spread) ** 2 < 1 << 31 else np.int64
    leaves, book = parts.astype(kind), entries.astype(kind)
    stack = [(0, n, 0, np.zeros(len(entries), kind))] if n else []
    while stack:
        a, b, depth, summed = stack.pop()
        if depth == width:
            best[a:b] = summed.argmin()
            error[a:b] = summed.min()
        elif b - a > LEAVES_AT_ONCE:
            values = leaves[a:b, depth]
            edges = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, b - a] + a
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                stack.append((x, y, depth + 1, summed + (leaves[x, depth] - book[:, depth]) ** 2))
        else:
            nodes, held = np.zeros(b - a, np.int64), summed[None, :]
            new = np.zeros(b - a, bool)
            new[0] = True
            for d in range(depth, width):
                column = leaves[a:b, d]
                new[1:] |= column[1:] != column[:-1]
                first = np.flatnonzero(new)
                held = held[nodes[first]] + (column[first, None] - book[None, :, d]) ** 2
                nodes = np.cumsum(new) - 1
            best[a:b] = held.argmin(axis=1)[nodes]
            error[a:b] = held.min(axis=1)[nodes]
    return best, error


def _whole_numbers(vector: str, scale: int) -> Column:
    """The components as long: scaled, rounded down, held to what sums exactly."""

    def one(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")

    return F.transform(vector, one)


def usable(vector: str) -> Column:
    """Neither null nor with a component that is null, infinite or not a number."""
    x = F.col(vector)

    def finite(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    return x.isNotNull() & F.forall(x, finite)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, VECTORS_AT_ONCE):
            block = batch.slice(at, VECTORS_AT_ONCE)
            yield block, block.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assign(vectors: np.ndarray, codebook: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part position: distinct parts, place of each vector's, counts, nearest entries, distances."""
    count, _, width = codebook.shape
    for p in range(count):
        leaves, place, times = distinct_parts(vectors[:, p * width : (p + 1) * width])
        best, error = nearest_entries(leaves, codebook[p])
        yield p, leaves, place, times, best, error


def _refined(kept: DataFrame, codebook: np.ndarray) -> np.ndarray:
    """The codebook with every used entry replaced by the mean of its parts, rounded down.

    A task sums its own parts up, each distinct one of a block once with its number of copies;
    only sums per entry are shuffled, so neither a large entry nor a common part meets in one task.
    """
    count, size, width = codebook.shape
    dim = count * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros((count, size), np.int64)
        sums = np.zeros((count, size, width), np.int64)
        for _, vectors in _blocks(batches, 0, dim):
            for p, leaves, _, copies, best, _ in _assign(vectors, codebook):
                np.add.at(times[p], best, copies)
                np.add.at(sums[p], best, leaves.astype(np.int64) * copies[:, None])
        used = np.argwhere(times > 0)
        rows = [used[:, 0], used[:, 1], times[tuple(used.T)]]
        listed = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * width, pa.array(sums[tuple(used.T)].ravel()))
        columns = [pa.array(r.astype(np.int32)) for r in rows[:2]] + [pa.array(rows[2]), listed]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "copies", "sums"])

    partial = kept.select("_parts").mapInArrow(run, "part int, entry int, copies long, sums array<long>")
    each = partial.select("part", "entry", "copies", F.posexplode("sums").alias("position", "total"))
    # One row for each number of the codebook comes to the driver.
    summed = each.groupBy("part", "entry", "position").agg(F.sum("copies").alias("copies"), F.sum("total").alias("total"))
    out = codebook.copy()
    for part, entry, position, copies, total in summed.collect():
        out[part, entry, position] = total // copies
    return out


def code_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256
) -> Codes:
    """All columns of ``vectors`` with ``code`` (entry of each part, array of int) and ``error`` (long).

    Components become whole numbers, ``floor(scale * x)``; vectors are cut into equal ``parts``. A position's first
    codebook is that part of the ``size`` rows with the smallest ids; each of ``rounds`` rounds
    assigns all parts to their nearest entries, ties to the lower index, and moves every used entry to the
    mean of its parts, rounded down. Then parts are assigned a last time. The codebook is
    ``parts * size`` entries on the driver and in every task; vectors are never shuffled.

    Rows whose vector is null or holds a null, infinite or undefined component are dropped, and so are those of
    another length than the row with the smallest id, or if that length cannot be cut into ``parts``, all.
    Fewer usable rows than ``size`` give a codebook of as many entries. A null id stands behind all others, equal ids
    are ordered by their vectors, repeated rows are all coded. Numbers beyond ``LARGEST`` after scaling are held to it. An empty
    table gives no rows and an empty codebook. Columns named ``code`` or ``error`` are replaced.
    """
    if parts < 1 or size < 1 or rounds < 0:
        raise ValueError("parts and size of at least one, rounds of none or more")
    spark = vectors.sparkSession
    whole = vectors.where(usable(vector_column)).withColumn("_parts", _whole_numbers(vector_column, scale))
    first = whole.select(F.col(id_column).alias("_id"), "_parts").orderBy(F.asc_nulls_last("_id"), "_parts").limit(size)
    # `size` rows.
    seeds = [r["_parts"] for r in first.collect()]
    dim = len(seeds[0]) if seeds else 0
    if dim == 0 or dim % parts:
        shape = "code array<int>, error long"
        empty = spark.createDataFrame([], shape)
        kept = vectors.drop("code", "error").limit(0)
        return Codes(kept.join(empty), np.zeros((parts, 0, 0), np.int64))
    if any(len(s) != dim for s in seeds):
        again = whole.where(F.size("_parts") == dim).select(F.col(id_column).alias("_id"), "_parts")
        seeds = [r["_parts"] for r in again.orderBy(F.asc_nulls_last("_id"), "_parts").limit(size).collect()]
    codebook = np.array(seeds, np.int64).reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2).copy()
    kept = whole.where(F.size("_parts") == dim)
    for _ in range(rounds):
        codebook = _refined(kept, codebook)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            codes, errors = [np.zeros((0, parts), np.int32)], [np.zeros(0, np.int64)]
            for at in range(0, len(flat), VECTORS_AT_ONCE):
                block = flat[at : at + VECTORS_AT_ONCE]
                code, total = np.empty((len(block), parts), np.int32), np.zeros(len(block), np.int64)
                for p, _, place, _, best, error in _assign(block, codebook):
                    code[:, p] = best[place]
                    total += error[place]
                codes.append(code)
                errors.append(total)
            code, total = np.concatenate(codes), np.concatenate(errors)
            listed = pa.ListArray.from_arrays(np.arange(len(code) + 1, dtype=np.int32) * parts, pa.array(code.ravel()))
            yield pa.StructArray.from_arrays([listed, pa.array(total)], names=["code", "error"])

    assign = F.arrow_udf(run, "struct<code: array<int>, error: bigint>").asNondeterministic()
    made = fresh(kept, "_coded")
    coded = kept.withColumn(made, assign("_parts")).drop("_parts")
    out = [c for c in vectors.columns if c.lower() not in ("code", "error")]
    return Codes(coded.select(*[F.col(f"`{c}`") for c in out], F.col(made)["code"].alias("code"), F.col(made)["error"].alias("error")), codebook)


def codebook_digest(codebook: np.ndarray) -> str:
    """SHA-256 of the decimal components by part, entry and position, with commas between them."""
    return hashlib.sha256(",".join(map(str, codebook.ravel().tolist())).encode()).hexdigest()


def decode_vectors(codes: DataFrame, codebook: np.ndarray, scale: int = 256, code_column: str = "code") -> DataFrame:
    """All columns of ``codes`` with ``decoded``: the vector of the entries a code names, null for a null code."""
    book = F.lit([[(e / scale).tolist() for e in part] for part in codebook])
    entries = F.transform(code_column, lambda c, i: F.get(F.get(book, i), c))
    return codes.withColumn("decoded", F.flatten(entries))


def code_digests(coded: Codes, id_column: str = "vec_id", label_column: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256): two hex digits a part, errors also summed over equal labels."""
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    rows = coded.vectors.select(id_column, F.array_join(digits, "").alias("code"), "error", F.col(label_column).alias("_label"))
    # Codes are a fraction of the vectors' size; written, so that vectors are assigned once for both readers.
    rows = written(rows, "codes")
    labels = rows.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    # Spark broadcasts the sums if there are few labels, and splits a hot label's partition otherwise.
    joined = rows.join(labels, F.col("_label").eqNullSafe(F.col("_of")), "left")
    return joined.select(id_column, "code", "error", "label_error", F.lit(codebook_digest(coded.codebook)).alias("codebooks_sha256"))
