"""Near-duplicates by SimHash, compared in bit-sliced blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import fresh, map_columns, with_struct, worker_tool
from commitlens.operators.identity import connected_components
from commitlens.session import written

SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
# Planes that are added before rows and lanes that are out of reach are left.
_PLANES_AT_ONCE = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats counted.

    A-Z are lower-cased; words are runs without ASCII white space. A text with fewer words than
    ``shingle`` has its whole word sequence as its one shingle; without words it is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, seed, join = xxhash.xxh64_intdigest, SEED, b" ".join
    ones = np.zeros(64, np.int64)
    step = 1 << 16
    shingles = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = np.fromiter((digest(join(s), seed) for s in shingles), "<u8", len(words) - shingle + 1)
    for at in range(0, len(hashes), step):
        part = np.unpackbits(hashes[at : at + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def signed(value: int) -> int:
    """An unsigned 64-bit number as a long has it."""
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int = 3) -> DataFrame:
    """(id, fp): a signed long with the fingerprint's bits for every row, in one narrow pass."""

    def make():
        worker_tool(None)

        def work(ids, texts):
            for i, text in zip(ids, texts, strict=True):
                yield i, signed(fingerprint(text, shingle))

        return work

    return map_columns(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")), make, "id long, fp long")


# -- bit-sliced comparison -----------------------------------------------------------------------


def planes_of(fps: np.ndarray) -> np.ndarray:
    """[64, ceil(n / 64)] words: bit j of word w of plane k is bit k of fingerprint 64 w + j."""
    lanes = -(-len(fps) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, planes: np.ndarray, count: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query index, lane) of every fingerprint within ``radius`` bits of a query.

    Distances to all lanes of a 64-lane word are updated together: the plane, inverted where the
    query's bit is 1, is added to vertical counters by a carry-save step of bitwise operations.
    Counters start so that passing the radius carries out of the top one, which marks a lane as
    out of reach for good. Every few planes, words whose lanes are all out of reach are abandoned.
    """
    high = max(1, int(radius + 1).bit_length())
    words = planes.shape[1]
    rows, cols = np.divmod(np.arange(len(queries) * words), words)
    start = (1 << high) - 1 - radius
    counters = [np.full(len(rows), _ALL if start >> b & 1 else np.uint64(0)) for b in range(high)]
    over = np.zeros(len(rows), np.uint64)
    if count % 64:
        over[cols == words - 1] = _ALL << np.uint64(count % 64)
    for first in range(0, 64, _PLANES_AT_ONCE):
        for k in range(first, first + _PLANES_AT_ONCE):
            flip = (queries >> np.uint64(k) & np.uint64(1)) * _ALL
            carry = planes[k][cols] ^ flip[rows]
            for b in range(high):
                counters[b], carry = counters[b] ^ carry, counters[b] & carry
            over |= carry
        left = over != _ALL
        if not left.all():
            rows, cols, over = rows[left], cols[left], over[left]
            counters = [c[left] for c in counters]
        if not len(rows):
            break
    near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(near)
    return rows[at], cols[at] * 64 + lane


def _links(fps: np.ndarray, block: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of all fingerprints of one sorted run that are near each other, blocks by blocks."""
    for at in range(0, len(fps), block):
        lanes = fps[at : at + block]
        planes = planes_of(lanes)
        for other in range(at, len(fps), block):
            q, lane = within(fps[other : other + block], planes, len(lanes), radius)
            a, b = q + other, lane + at
            yield a[a > b], b[a > b]


def _forest(size: int, a: np.ndarray, b: np.ndarray, root: list[int]) -> list[tuple[int, int]]:
    """Those of the pairs that join two trees so far: as many links as connect the same nodes."""

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def _compare(radius: int, block: int):
    """Compare the fingerprints of each cell of a partition sorted by cell; give the links.

    Small neighbouring cells share a block: a pair from two cells that is near is a true link as
    well. A cell is never larger than the operator's cell size.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def flush(fps: list[np.ndarray]) -> pa.RecordBatch:
        values = np.unique(np.concatenate(fps))
        root = list(range(len(values)))
        links = [p for a, b in _links(values.view(np.uint64), block, radius) for p in _forest(len(values), a, b, root)]
        pairs = values[np.array(links, np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy()
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            if last is None or (cell[0] != last).any():
                cuts = np.concatenate([[0], cuts])
            at = 0
            for cut in cuts.tolist():
                # A cut is where a cell ends: enough cells together are compared.
                held.append(fps[at:cut])
                size += cut - at
                at = cut
                if size >= block:
                    yield flush(held)
                    held, size = [], 0
            held.append(fps[at:])
            size += len(fps) - at
            last = cell[-1]
        if size:
            yield flush(held)

    return run


def _key(fp: Column, radius: int, parts: int) -> Column:
    """One (table, key) per choice of ``parts - radius`` of ``parts`` bit ranges.

    Fingerprints within the radius differ in at most ``radius`` ranges, so they agree on all the
    ranges of at least one choice.
    """
    edges = [64 * i // parts for i in range(parts + 1)]
    tables = []
    for number, chosen in enumerate(combinations(range(parts), parts - radius)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        mask = mask - (1 << 64) if mask >> 63 else mask
        tables.append(F.struct(F.lit(number).cast("long").alias("t"), fp.bitwiseAND(F.lit(mask)).alias("k")))
    return F.explode(F.array(*tables))


def near_links(
    distinct: DataFrame, radius: int = 3, parts: int | None = None, block: int = 512, cell: int = 32_768
) -> DataFrame:
    """(a, b): links between the distinct values of column ``fp`` that connect exactly what is near.

    All pairs within ``radius`` bits end up connected; within a compared run only a spanning
    forest of its near pairs is given. ``parts`` bit ranges make ``parts`` choose ``radius`` tables
    (radius + 2 by default); a pair within the radius shares a key in at least one. A key with
    more than ``cell`` different fingerprints is cut into pieces, and every two pieces meet in a
    cell of their own, so nothing is left out and no task holds more than two pieces.
    """
    parts = parts or radius + 2
    keyed = distinct.select("fp", _key(F.col("fp"), radius, parts).alias("key")).select("fp", "key.t", "key.k")
    sizes = keyed.groupBy("t", "k").count().where(F.col("count") > 1)
    pieces = F.ceil(F.col("count") / F.lit(cell)).cast("int")
    piece = F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.col("n")).cast("int")
    # Piece i meets piece j in cell (min, max); with one piece that is cell 0.
    cells = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda j: F.least(F.col("p"), j).cast("long") * F.lit(1 << 20) + F.greatest(F.col("p"), j),
    )
    dealt = (
        keyed.join(sizes, ["t", "k"])
        .withColumn("n", pieces)
        .withColumn("p", piece)
        .select("t", "k", F.explode(cells).alias("c"), "fp")
    )
    # Close keys side by side in few tasks; a task's rows are compared in runs of whole cells.
    together = dealt.repartition("t", "k", "c").sortWithinPartitions("t", "k", "c", "fp")
    return together.mapInArrow(_compare(radius, block), "a long, b long").distinct()


def near_components(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component): for every distinct fingerprint, the smallest id its links lead to.

    Ids that are null name no component; a component of nothing but null ids is null.
    """
    named = written(fps.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    groups = connected_components(near_links(named.select("fp"), radius), "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("root"))
    linked = groups.join(named, "fp")
    least = linked.groupBy("root").agg(F.min("id").alias("component"))
    reached = linked.join(least, "root").select("fp", "component")
    alone = named.join(reached, "fp", "left_anti").select("fp", F.col("id").alias("component"))
    return alone.unionByName(reached)


def simhash_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest id reachable over
    links of at most ``radius`` bits, the row's own included. A null text counts as empty, empty
    texts have fingerprint zero and are linked like any other; repeated rows give repeated rows; an
    empty table gives none; a null id takes part but names no component. Other columns are not read.
    """
    fps = written(fingerprints(docs, id_column, text_column, shingle), "simhash")
    return fps.join(near_components(fps, radius), "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row of each group of near-duplicates of ``docs``: the smallest id, then the smallest hash of the text.

    Rows are told apart, not ids: rows without an id take part and stand behind all others, different texts under
    one id are compared like any others, and of rows that are equal in id and text one stays. A group's first row is a minimum that is
    aggregated before it is shuffled, so neither a hot id nor a large group meets in one task. All columns are kept as they are; of
    equal rows with other columns that differ, the one that was read first stays.
    """
    number, text = fresh(docs, "row"), F.coalesce(F.col(text_column), F.lit(""))
    # Written, so that a row keeps its number whatever is computed again.
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col(id_column).isNull(), F.col(id_column), F.xxhash64(text), F.xxhash64(F.lit(1), text), F.col(number).alias("row"))

    def make():
        worker_tool(None)
        return lambda value: (signed(fingerprint(value, shingle)),)

    printed = with_struct(rows.select(id_column, text_column, number), "_print", "fp long", make, text_column)
    # One row a fingerprint from here on.
    firsts = written(printed.groupBy(F.col("_print.fp").alias("fp")).agg(F.min(order).alias("first")), "simhash")
    groups = firsts.join(near_components(firsts.select("fp", F.col("first.row").alias("id")), radius), "fp")
    kept = groups.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias(number))
    return rows.join(kept, number, "left_semi").drop(number)
