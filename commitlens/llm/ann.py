"""Nearest neighbours by inner product: inverted lists scanned dimension by dimension."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitlens.session import written

#: Bounds of the fitting sample: vectors, and their numbers in all (32 MB).
SAMPLE_ROWS, SAMPLE_NUMBERS = 16_384, 4_000_000
# Fewer vectors than this are one list. Rows of a list, and queries, that one task takes at a time.
_ONE_LIST, _BLOCK = 1_000, 4_096
# Columns added before candidates are tested, and how unlikely a wrong abandonment shall be: the
# test leaves a candidate whose scaled partial distance exceeds the radius by this many deviations.
_COLUMNS, _STRICTNESS = 16, 2.1
# Pairs of a query and a candidate in memory at one time.
_PAIRS = 200_000
# Queries compared with the sample at one time.
_QUERIES = 256


@dataclass
class Index:
    """What the sample teaches: lists, how many a query visits, and a rotation.

    Largest inner products become smallest distances by one more dimension, sqrt(M^2 - |x|^2) for
    rows and 0 for queries, M being the largest length of all rows. A random rotation spreads every vector's
    length evenly over the dimensions, so that a partial distance tells of the whole.
    """

    top: float
    centres: np.ndarray
    probes: int
    rotation: np.ndarray
    guides: np.ndarray
    guide_ids: np.ndarray
    guide_homes: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - np.einsum("ij,ij->i", x, x), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def visited(self, x: np.ndarray, sizes: np.ndarray, k: int) -> list[np.ndarray]:
        """The lists each query visits, nearest first: ``probes``, or more if these have too few rows for ``k`` others."""
        near = np.argsort(_distances(self.queries(x), self.centres), axis=1, kind="stable")
        enough = (np.cumsum(sizes[near], axis=1) <= k).sum(axis=1) + 1
        return [lists[: max(self.probes, n)] for lists, n in zip(near, enough, strict=True)]

    def radius(self, ids: np.ndarray, x: np.ndarray, visited: list[np.ndarray], k: int) -> np.ndarray:
        """A squared distance within which each query has ``k`` guides in the lists it visits; infinite without as many."""
        if len(self.guide_ids) < k:
            return np.full(len(x), np.inf)
        there = np.zeros((len(x), len(self.centres)), bool)
        for row, lists in zip(there, visited, strict=True):
            row[lists] = True
        usable = there[:, self.guide_homes] & (ids[:, None] != self.guide_ids[None])
        worst = -np.partition(np.where(usable, -(x @ self.guides.T), np.inf), k - 1, axis=1)[:, k - 1]
        return np.maximum((x * x).sum(axis=1) + self.top - 2 * worst, 0.0) * (1 + 1e-9)

    @staticmethod
    def queries(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column, all of one length, as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in one order: equal vectors tie to the last bit wherever measured."""
    return np.add.reduce(np.ascontiguousarray(a * b), axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0.0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=k)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def train(ids: np.ndarray, sample: np.ndarray, total: int, top: float, k: int, recall: float, seed: int = 5) -> Index:
    """Fit lists on a sample and choose how many a query visits.

    The sample's own exact neighbours decide: visits are as many as the share ``recall`` of them
    needs. In the whole table neighbours are nearer than in the sample, so it holds there as well.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    index = Index(top, np.zeros((1, dim)), 1, rotation, sample, ids, np.zeros(len(ids), np.int64))
    # Lists are laid over distinct vectors; a repeated one would draw centres to itself.
    distinct = np.unique(sample, axis=0)
    lists = 1 if total < _ONE_LIST else round(total**0.5 / 2)
    lists = max(1, min(lists, len(distinct) // 8, 4_096))
    index.centres = _kmeans(index.rows(distinct), lists, rng) if lists > 1 else index.rows(distinct[:1])
    index.probes = lists
    if lists > 1:
        # Visits are measured on rows as they come, repeated ones among them.
        rows = index.rows(sample)
        own = rng.choice(len(sample), min(512, len(sample)), replace=False)
        queries = index.queries(sample[own])
        near = _distances(queries, rows)
        near[np.arange(len(own)), own] = np.inf
        best = np.argpartition(near, min(k, near.shape[1] - 1), axis=1)[:, :k]
        index.guide_homes = home = _distances(rows, index.centres).argmin(axis=1)
        rank = _distances(queries, index.centres).argsort(axis=1).argsort(axis=1)
        needed = np.take_along_axis(rank, home[best], axis=1)
        index.probes = min(lists, int(np.quantile(needed, recall)) + 1)
    return index


def scan(
    query_ids: np.ndarray, queries: np.ndarray, radius: np.ndarray, ids: np.ndarray, rows: np.ndarray, index: Index, k: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query id, id, inner product) of the up to ``k`` best rows of one block for every query.

    Distances grow column block by column block. After d of D rotated dimensions, the partial distance times D/d estimates
    the whole one with a deviation that shrinks as 1/sqrt(d); a candidate whose estimate lies beyond the query's radius
    by more than the test allows is abandoned. What is left at the end is measured exactly on the original vectors, and
    the k-th best so far tightens the radius for the rows to come.
    """
    q, x = index.queries(queries) @ index.rotation, index.rows(rows) @ index.rotation
    dim = q.shape[1]
    slack = 1e-9 * max(index.top, 1.0)
    # Products to distances: |q|^2 + M^2 - 2 q.x
    own = (queries * queries).sum(axis=1) + index.top
    radius = radius.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held_q, held_id = np.empty(0, np.int64), np.empty(0, np.int64)
    held_score = np.empty(0)
    step = max(16, _PAIRS // max(1, len(q)))
    for first in range(0, len(x), step):
        part, part_ids = x[first : first + step], ids[first : first + step]
        partial = _distances(q[:, :_COLUMNS], part[:, :_COLUMNS])
        seen = min(_COLUMNS, dim)
        at_q, at_x = np.nonzero(_near(partial, radius[:, None], seen, dim, slack) & (query_ids[:, None] != part_ids[None]))
        left = partial[at_q, at_x]
        while seen < dim and len(at_q):
            upto = min(seen + _COLUMNS, dim)
            more = q[at_q, seen:upto] - part[at_x, seen:upto]
            left = left + np.einsum("ij,ij->i", more, more)
            seen = upto
            good = _near(left, radius[at_q], seen, dim, slack)
            at_q, at_x, left = at_q[good], at_x[good], left[good]
        if not len(at_q):
            continue
        score = _products(queries[at_q], rows[first + at_x])
        held_q = np.concatenate([held_q, at_q])
        held_id = np.concatenate([held_id, part_ids[at_x]])
        held_score = np.concatenate([held_score, score])
        order = np.lexsort((held_id, -held_score, held_q))
        held_q, held_id, held_score = held_q[order], held_id[order], held_score[order]
        start = np.searchsorted(held_q, held_q)
        rank = np.arange(len(held_q)) - start
        full = rank == k - 1
        radius[held_q[full]] = np.minimum(radius[held_q[full]], np.maximum(own[held_q[full]] - 2 * held_score[full], 0.0))
        keep = rank < k
        held_q, held_id, held_score = held_q[keep], held_id[keep], held_score[keep]
    if len(held_q):
        found.append((query_ids[held_q], held_id, held_score))
    return found


def _near(partial: np.ndarray, radius: np.ndarray, seen: int, dim: int, slack: float) -> np.ndarray:
    """Candidates whose partial squared distance does not rule them out; exact once all is seen."""
    allowed = 1.0 if seen >= dim else seen / dim * (1 + _STRICTNESS / np.sqrt(seen)) ** 2
    return partial <= radius * allowed + slack


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector): rows that take part, one for every id, vectors as doubles."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    good = picked.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    lengths = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    same = good.where(F.size("vector") == (lengths[0].n if lengths else 0))
    return same.groupBy("id").agg(F.min("vector").alias("vector"))


def fit(rows: DataFrame, k: int, recall: float) -> Index | None:
    """An index over ``rows`` (id, vector), learned from a bounded sample; None without rows."""
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("top"), F.max(F.size("vector")).alias("dim")).first()
    if not stats.n:
        return None
    size = max(256, min(SAMPLE_ROWS, SAMPLE_NUMBERS // stats.dim))
    sample = rows.orderBy(F.xxhash64("id")).limit(size).collect()
    ids = np.array([r.id for r in sample], np.int64)
    return train(ids, np.array([r.vector for r in sample]), stats.n, stats.top, k, recall)


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    recall: float = 0.97,
) -> DataFrame:
    """(query_id, rank, id, score): for rows whose id ``every`` divides, the ``k`` nearest others found.

    Nearest is the largest inner product in double precision, ties to the smaller id; ``score`` is
    measured on the original vectors. All rows are indexed; of the lists a query visits, all rows are
    scanned. A list with more rows than a block is cut into blocks by a hash of the id, and the queries
    of a block likewise, so a list that holds a third of all rows spreads over as many tasks as it
    needs. Every block gives at most ``k`` rows a query. Those of the sample in the lists a query visits give it its
    first radius, but no answers: these come from the scan alone. A query that the scan leaves with fewer than ``k``
    is scanned again without that radius. Null ids, null or zero vectors, vectors with a null or
    non-finite component and those of another length than most take no part; of rows with the same id the
    smallest vector does. Few rows are searched exhaustively; an empty table gives no rows. No other column is read.
    """
    rows = written(usable(vectors, id_column, vector_column), "vectors")
    index = fit(rows, k, recall)
    if index is None:
        return rows.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_column), F.lit(0.0).alias("score")
        ).where(F.lit(False))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            near = [_distances(index.rows(x[i : i + _BLOCK]), index.centres).argmin(axis=1) for i in range(0, len(x), _BLOCK)]
            lists = np.concatenate([np.empty(0, np.int64), *near]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=["id", "vector", "list"])

    homes = written(rows.mapInArrow(home, "id long, vector array<double>, list int"), "homes")
    # One row for each list, of which there are at most 4 096.
    counts = homes.groupBy("list").count().collect()
    rows_of = np.zeros(len(index.centres), np.int64)
    rows_of[[r["list"] for r in counts]] = [r["count"] for r in counts]

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _QUERIES):
                batch = whole.slice(at, _QUERIES)
                own, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
                near = index.visited(x, rows_of, k)
                columns = [pa.array(index.radius(own, x, near, k)), pa.array([c.astype(np.int32) for c in near], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["id", "vector", "radius", "lists"])

    asked = rows.where(F.col("id") % every == 0)
    query_blocks = max(1, -(-asked.count() // _BLOCK))
    sizes = homes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))
    in_block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part")
    cells = homes.join(F.broadcast(sizes), "list").select("list", in_block, "id", "vector", every_part)
    queries = written(asked.mapInArrow(visits, "id long, vector array<double>, radius double, lists array<int>"), "queries")
    part = F.pmod(F.xxhash64(F.lit("query"), "id"), F.lit(query_blocks)).cast("int").alias("part")
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")

    def cell(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(own) and len(others):
            parts = scan(
                own["id"].to_numpy(np.int64), np.stack(own["vector"].to_numpy()), own["radius"].to_numpy(np.float64),
                others["id"].to_numpy(np.int64), np.stack(others["vector"].to_numpy()), index, k,
            )
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pd.DataFrame(dict(zip(["query_id", "id", "score"], columns, strict=True)))

    at = ["list", "block", "part"]

    def scanned(some: DataFrame) -> DataFrame:
        wanted = some.select("id", "vector", "radius", part, F.explode("lists").alias("list")).join(F.broadcast(sizes), "list")
        wanted = wanted.select("list", all_blocks, "id", "vector", "radius", "part")
        return wanted.groupBy(*at).cogroup(cells.groupBy(*at)).applyInPandas(cell, "query_id long, id long, score double")

    found = written(scanned(queries), "found")
    # Near the first radius the test abandons a few rows wrongly, so that some queries lack answers.
    answers = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("answers"))
    lacking = queries.join(answers, "id", "left").where(F.coalesce("answers", F.lit(0)) < min(k, int(rows_of.sum()) - 1))
    lacking = written(lacking.select("id", "vector", F.lit(float("inf")).alias("radius"), "lists"), "lacking")
    if not lacking.isEmpty():
        found = found.join(lacking.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(scanned(lacking))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
