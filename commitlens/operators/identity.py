"""Which keys belong together because rows mention them side by side."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.operators.ranking import top_n_per_key
from commitlens.session import Scratch, written

# Steps along the picks within one round; deeper trees are finished in the next round.
_STEPS = 3
# How many hops beyond its neighbours a node looks for its pick: a join and a minimum each, without a write,
# where another round would take several of both.
_FARTHER = 2
# Seeds of a block as a power of two, the edges around a block that one task holds at most, and keys in a list.
_BLOCK_BITS = 12
_AROUND = 4_000_000
_LISTED = 8_192


def _numbered(pairs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, id) for all nodes, and the pairs by id; ids are dense numbers in the order of the nodes' hashes."""
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    spread = nodes.repartitionByRange(F.xxhash64("node"), "node").sortWithinPartitions(F.xxhash64("node"), "node")
    # Written, so that every reader sees the same numbers.
    ids = scratch.write(spread.withColumn("id", F.monotonically_increasing_id()), "nodes")
    left = pairs.join(ids.select(F.col("node").alias("u"), F.col("id").alias("a")), "u").select("a", "v")
    return ids, left.join(ids.select(F.col("node").alias("v"), F.col("id").alias("b")), "v").select("a", "b")


def _contract(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of a graph of distinct pairs u < v.

    Nodes are numbered once, in an order that has nothing to do with the graph, and rounds work on
    the numbers. Each round every node picks the smallest number within a few hops.
    Picks lead to ever smaller numbers, so they form trees; following them a few steps and
    rebuilding the graph over the nodes arrived at shrinks it several times over. The number of
    rounds grows with the logarithm of the graph's size, not with its diameter. Each round's
    outcome is a written table, so a lost executor costs one round at most; a round's tables are removed
    when the next one's are written. The pick is a minimum of numbers, which Spark aggregates before it shuffles.
    """
    ids, numbered = _numbered(pairs, scratch)
    here = Scratch(pairs.sparkSession)
    graph = here.write(_ordered(numbered, "a", "b"), "graph")
    rounds: list[DataFrame] = []
    while not graph.isEmpty():
        both = graph.union(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("c"))
        for _ in range(_FARTHER):
            near = best.select(F.col("u").alias("v"), "c")
            best = both.join(near, "v").groupBy("u").agg(F.min("c").alias("c"))
        picks = here.write(best.select(F.col("u").alias("node"), F.col("c").alias("rep")), "picks")
        onward = picks.select(F.col("node").alias("rep"), F.col("rep").alias("next"))
        arrived = picks
        for _ in range(_STEPS):
            arrived = arrived.join(onward, "rep").select("node", F.col("next").alias("rep"))
        arrived = scratch.write(arrived, "arrived")
        rounds.append(arrived)
        moved = graph.join(arrived.select(F.col("node").alias("u"), F.col("rep").alias("a")), "u").select("a", "v")
        moved = moved.join(arrived.select(F.col("node").alias("v"), F.col("rep").alias("b")), "v").select("a", "b")
        after = Scratch(pairs.sparkSession)
        graph = after.write(_ordered(moved.where("a != b"), "a", "b").distinct(), "graph")
        here.drop()
        here = after
    here.drop()

    # From the last round back to the first: where a node arrived, and where that one ended up.
    labels = ids.select(F.col("id").alias("node"), F.col("id").alias("rep")).where(F.lit(False))
    for arrived in reversed(rounds):
        later = labels.select(F.col("node").alias("rep"), F.col("rep").alias("last"))
        labels = arrived.join(later, "rep", "left").select("node", F.coalesce("last", "rep").alias("rep"))
    names = ids.select(F.col("id").alias("rep"), F.col("node").alias("component"))
    named = labels.join(names, "rep").select(F.col("node").alias("id"), "component")
    return ids.join(named, "id").select("node", "component")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))


def _distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return _ordered(df.where(F.col(a) != F.col(b)), a, b).distinct()


def _components(pairs: DataFrame) -> DataFrame:
    scratch = Scratch(pairs.sparkSession)
    found = written(_contract(scratch.write(pairs, "pairs"), scratch), "components")
    scratch.drop()
    return found


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an undirected graph given by its edge list."""
    labels = _components(_distinct_pairs(edges, a, b))
    loops = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    alone = loops.join(labels, "node", "left_anti").withColumn("component", F.col("node"))
    return labels.unionByName(alone)


def exact_key(columns: list[str]) -> Column:
    """One string for several string columns; different values, nulls included, give different strings."""
    parts = [
        F.concat(
            F.coalesce(F.length(c).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(c), F.lit(""))
        )
        for c in columns
    ]
    return F.concat(*parts)


def resolve_identities(
    rows: DataFrame,
    row_keys: list[str],
    key: str,
    ignore_keys: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Cluster the values of ``key`` that share a row, rows being given by string ``row_keys``.

    ``rows`` is long: one line per row and key. Returns (row, component), ``row`` being the
    ``exact_key`` of the row, and (key, component). Rows and keys are the two sides of one graph,
    so a row with a million keys costs a million edges, never their pairs. Null keys and
    ``ignore_keys`` join nothing; a row that has no other keys is not in the result.
    """
    usable = rows.where(F.col(key).isNotNull())
    if ignore_keys:
        usable = usable.where(~F.col(key).isin(ignore_keys))
    edges = usable.select(F.concat(F.lit("r"), exact_key(row_keys)).alias("r"), F.concat(F.lit("k"), F.col(key)).alias("k"))
    components = _components(_distinct_pairs(edges, "r", "k"))
    name = F.expr("substr(node, 2)")
    row_side = components.where(F.col("node").startswith("r")).select(name.alias("row"), "component")
    key_side = components.where(F.col("node").startswith("k")).select(name.alias(key), "component")
    return row_side, key_side


def _sides(rows: DataFrame, row_keys: list[str], key: str, ignore_keys: list[str] | None) -> DataFrame:
    """Distinct (r, k): which key stands in which row."""
    usable = rows.where(F.col(key).isNotNull())
    if ignore_keys:
        usable = usable.where(~F.col(key).isin(ignore_keys))
    return usable.select(exact_key(row_keys).alias("r"), F.col(key).alias("k")).distinct()


def first_key_within(
    rows: DataFrame, row_keys: list[str], key: str, hops: int, ignore_keys: list[str] | None = None
) -> DataFrame:
    """(key, first_key): the smallest key that each one reaches in at most ``hops`` hops, itself included.

    A hop leads from a key to its rows and from these to their keys. It goes through the row's node: a row passes on
    the smallest key that has come to it, so a hop costs the edges twice, whatever the rows' sizes, and
    two keys of a row with a million never meet as a pair. With enough hops these are the components of
    ``resolve_identities``.
    """
    if hops < 0:
        raise ValueError(hops)
    scratch = Scratch(rows.sparkSession)
    pairs = scratch.write(_sides(rows, row_keys, key, ignore_keys), "sides")
    ordered = pairs.select("k").distinct().repartitionByRange("k").sortWithinPartitions("k")
    # Numbers in the order of the keys: a minimum of numbers is aggregated by hashing, before it is shuffled.
    numbers = scratch.write(ordered.withColumn("n", F.monotonically_increasing_id()), "numbers")
    edges = scratch.write(pairs.join(numbers, "k").select("r", "n"), "edges")
    labels = numbers.select("n", F.col("n").alias("least"))
    for _ in range(hops):
        arrived = edges.join(labels, "n").groupBy("r").agg(F.min("least").alias("least"))
        labels = scratch.write(edges.join(arrived, "r").groupBy("n").agg(F.min("least").alias("least")), "labels")
    names = numbers.select(F.col("n").alias("least"), F.col("k").alias("first_key"))
    found = written(labels.join(numbers, "n").join(names, "least").select(F.col("k").alias(key), "first_key"), "within")
    scratch.drop()
    return found


def keys_within(
    rows: DataFrame, row_keys: list[str], key: str, seeds: DataFrame, hops: int, ignore_keys: list[str] | None = None
) -> DataFrame:
    """(seed, key, hops): all keys that each of the ``seeds`` reaches, and in how few hops; at most ``hops``.

    The result has a row per seed and key, which for all keys as seeds is the square of a cluster's size, so these
    pairs are never shuffled nor written: they are made where they are read. Seeds that lie near one another
    are put in blocks, the rows and keys around a block are brought together once, and a task walks them from 64 seeds
    at a time, a bit each. What moves grows with the rows around the blocks. A block that has more than ``_AROUND`` of
    these is left to joins of seeds and rows instead, which no task has to hold.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    pairs = scratch.write(_sides(rows, row_keys, key, ignore_keys), "sides")
    start = seeds.select(F.col(key).alias("k")).distinct()
    if hops < 1:
        found = written(start.join(pairs.select("k").distinct(), "k", "left_semi"), "reached")
        scratch.drop()
        return found.select(F.col("k").alias("seed"), F.col("k").alias(key), F.lit(0).alias("hops"))
    numbers = scratch.write(pairs.select("k").distinct().withColumn("n", F.monotonically_increasing_id()), "numbers")
    row_numbers = scratch.write(pairs.select("r").distinct().withColumn("m", F.monotonically_increasing_id()), "rows")
    edges = scratch.write(pairs.join(numbers, "k").join(row_numbers, "r").select("m", "n"), "edges")
    # The smallest number nearby: what has the same one lies together, mostly.
    labels = numbers.select("n", F.col("n").alias("least"))
    for _ in range(min(hops, _FARTHER)):
        arrived = edges.join(labels, "n").groupBy("m").agg(F.min("least").alias("least"))
        labels = scratch.write(edges.join(arrived, "m").groupBy("n").agg(F.min("least").alias("least")), "labels")
    dealt = start.join(numbers, "k").join(labels, "n").repartitionByRange("least", "n").sortWithinPartitions("least", "n")
    dealt = dealt.select("n", F.monotonically_increasing_id().alias("at"))
    block = F.shiftright("at", _BLOCK_BITS).alias("block")
    blocks = scratch.write(dealt.select("n", block), "blocks")
    near = blocks
    for hop in range(1, hops + 1):
        around = near.join(edges, "n").select("block", "m").distinct()
        if hop < hops:
            near = scratch.write(around.join(edges, "m").select("block", "n").distinct(), "near")
    around = scratch.write(around.join(edges, "m").select("block", "m", "n"), "around")
    large = scratch.write(around.groupBy("block").count().where(F.col("count") > _AROUND).select("block"), "large")
    rest = None
    if not large.isEmpty():
        names = blocks.join(large, "block", "left_semi").join(numbers, "n").select(F.col("k").alias("seed"), "k")
        rest = _joined_within(scratch, pairs, names, hops)
        around = around.join(F.broadcast(large), "block", "left_anti")
    named = numbers.join(blocks.withColumnRenamed("block", "own"), "n", "left")
    around = written(around.join(named, "n").select("block", "m", "n", "k", F.coalesce(F.col("own") == F.col("block"), F.lit(False)).alias("asks")), "around")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = around.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(
        partial(_walked, hops=hops), "seed string, hops int, keys array<string>"
    )
    found = found.select("seed", F.explode("keys").alias(key), "hops")
    if rest is not None:
        found = found.unionByName(written(rest.select("seed", F.col("k").alias(key), "hops"), "reached"))
    scratch.drop()
    return found


def _joined_within(scratch: Scratch, edges: DataFrame, front: DataFrame, hops: int) -> DataFrame:
    """(seed, k, hops) by joins: from hop to hop only what is new goes on, and a row is entered once for a seed."""
    front = scratch.write(front, "front")
    reached, entered = front.withColumn("hops", F.lit(0)), None
    for hop in range(1, hops + 1):
        inside = front.join(edges, "k").select("seed", "r").distinct()
        if entered is not None:
            inside = inside.join(entered, ["seed", "r"], "left_anti")
        inside = scratch.write(inside, "inside")
        entered = inside if entered is None else entered.unionByName(inside)
        new = inside.join(edges, "r").select("seed", "k").distinct().join(reached.select("seed", "k"), ["seed", "k"], "left_anti")
        front = scratch.write(new, "front")
        reached = reached.unionByName(front.withColumn("hops", F.lit(hop)))
        if front.isEmpty():
            break
    return reached


def _walked(batches: Iterator[pa.RecordBatch], hops: int) -> Iterator[pa.RecordBatch]:
    """Per seed and distance the keys; what belongs to one block comes together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            here = batch.column("block")[0].as_py()
            if held and held[0].column("block")[0].as_py() != here:
                yield from _block_walked(pa.Table.from_batches(held), hops)
                held = []
            n = int(np.searchsorted(batch.column("block").to_numpy(), here, side="right"))
            held.append(batch.slice(0, n))
            batch = batch.slice(n)
    if held:
        yield from _block_walked(pa.Table.from_batches(held), hops)


def _block_walked(edges: pa.Table, hops: int) -> Iterator[pa.RecordBatch]:
    _, first, keys = np.unique(edges.column("n").to_numpy(), return_index=True, return_inverse=True)
    _, rows = np.unique(edges.column("m").to_numpy(), return_inverse=True)
    names = edges.column("k").combine_chunks().take(pa.array(first))
    by_row, by_key = np.argsort(rows, kind="stable"), np.argsort(keys, kind="stable")
    row_at, key_at = np.flatnonzero(np.diff(rows[by_row], prepend=-1)), np.flatnonzero(np.diff(keys[by_key], prepend=-1))
    keys_of, rows_of = keys[by_row], rows[by_key]
    asking = np.flatnonzero(edges.column("asks").to_numpy()[first])
    for at in range(0, len(asking), 64):
        seeds = asking[at : at + 64]
        reached = np.zeros(len(first), np.uint64)
        reached[seeds] = np.uint64(1) << np.arange(len(seeds), dtype=np.uint64)
        new = reached
        for hop in range(hops + 1):
            if hop:
                entered = np.bitwise_or.reduceat(reached[keys_of], row_at)
                after = np.bitwise_or.reduceat(entered[rows_of], key_at)
                new, reached = after & ~reached, after
            some = np.flatnonzero(new)
            if not len(some):
                break
            for piece in range(0, len(some), _LISTED):
                these = some[piece : piece + _LISTED]
                bits = np.unpackbits(new[these].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                who, what = np.nonzero(bits[:, : len(seeds)].T)
                counts = np.bincount(who, minlength=len(seeds))
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), names.take(pa.array(these[what])))
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(seeds)), pa.array(np.full(len(seeds), hop, np.int32)), listed], names=["seed", "hops", "keys"]
                )


def canonical_identities(key_side: DataFrame, key: str, max_keys: int) -> DataFrame:
    """(component, identity, key_count) of the components with at most ``max_keys`` keys.

    The identity is the sorted, pipe-joined list of the keys. Larger components are left out: of
    each, no more than ``max_keys + 1`` keys are ever brought together, enough to know its size
    is over the limit.
    """
    few = top_n_per_key(key_side, ["component"], [F.col(key)], max_keys + 1)
    return (
        few.groupBy("component")
        .agg(F.array_sort(F.collect_list(key)).alias("_keys"))
        .where(F.size("_keys") <= max_keys)
        .select(
            "component",
            F.array_join("_keys", "|").alias("identity"),
            F.size("_keys").alias("key_count"),
        )
    )


def component_sizes(key_side: DataFrame, key: str) -> DataFrame:
    """(component, first_key, key_count) for components of any size."""
    return key_side.groupBy("component").agg(
        F.min(key).alias("first_key"), F.count(F.lit(1)).alias("key_count")
    )
