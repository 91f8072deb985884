import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from commitlens.operators import aggregates, filters, identity, joins, ranking
from commitlens.session import shared_dir


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    groups = defaultdict(set)
    for x in list(parent):
        groups[find(x)].add(x)
    return {frozenset(g) for g in groups.values()}


def components(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    groups = defaultdict(set)
    for r in identity.connected_components(df, "a", "b").collect():
        groups[r.component].add(r.node)
    return {frozenset(g) for g in groups.values()}


def test_components_shapes(spark):
    path = [(f"p{i}", f"p{i + 1}") for i in range(40)]
    random.Random(1).shuffle(path)
    star = [("hub", f"s{i}") for i in range(50)]
    edges = path + star + [("alone", "alone"), ("x", "y"), ("y", "x")]
    assert components(spark, edges) == union_find(edges)


def test_components_random(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(220)]
    assert components(spark, edges) == union_find(edges)


def test_components_with_shuffled_joins(spark, no_broadcast):
    # A hub in a third of the edges, no broadcast anywhere.
    rng = random.Random(6)
    edges = [("hub", f"n{i}") for i in range(12)] + [(f"m{rng.randrange(20)}", f"m{rng.randrange(20)}") for _ in range(24)]
    assert components(spark, edges) == union_find(edges)


def test_components_of_nothing(spark):
    assert components(spark, [("a", "a")]) == {frozenset("a")}
    df = spark.createDataFrame([], "a string, b string")
    assert identity.connected_components(df, "a", "b").count() == 0


def test_identities(spark):
    rows = [("r1", "b"), ("r1", "c"), ("r2", "a"), ("r2", "b"), ("r3", "c"), ("r3", "d"), ("r4", "z"), ("r5", None)]
    rows += [("many", f"m{i:02}") for i in range(16)] + [("fits", f"f{i:02}") for i in range(15)]
    df = spark.createDataFrame(rows, "row string, key string").repartition(3)
    row_side, key_side = identity.resolve_identities(df, ["row"], "key")
    people = {r.component: (r.identity, r.key_count) for r in identity.canonical_identities(key_side, "key", 15).collect()}
    assert set(people.values()) == {("a|b|c|d", 4), ("z", 1), ("|".join(f"f{i:02}" for i in range(15)), 15)}
    by_row = {r.row: people.get(r.component) for r in row_side.collect()}
    assert by_row["2:r1"] == by_row["2:r2"] == by_row["2:r3"] == ("a|b|c|d", 4)
    assert by_row["4:many"] is None and "2:r5" not in by_row
    sizes = {r.key_count for r in identity.component_sizes(key_side, "key").collect()}
    assert sizes == {4, 1, 15, 16}


def test_ignored_keys(spark):
    df = spark.createDataFrame([("r1", ""), ("r1", "a"), ("r2", ""), ("r2", "b")], "row string, key string")
    joined = identity.resolve_identities(df, ["row"], "key")[1]
    apart = identity.resolve_identities(df, ["row"], "key", ignore_keys=[""])[1]
    assert joined.select("component").distinct().count() == 1
    assert apart.select("component").distinct().count() == 2


def test_exact_key(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("1:a", None), (None, "1:a"), ("", None), (None, "")], "x string, y string")
    assert df.select(identity.exact_key(["x", "y"]).alias("k")).distinct().count() == 6


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_of_hot_and_null_keys(spark, no_broadcast, how):
    rng = random.Random(2)
    facts = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{rng.randrange(200)}", i) for i in range(3000)]
    f = spark.createDataFrame(facts, "k string, i int").repartition(6)
    lookup = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 200, 2)], "kk string, v string")
    got = joins.lookup_join(f, lookup, [("k", "kk")], how)
    values = dict(lookup.collect())
    expected = Counter((k, i, values.get(k)) for k, i in facts if how == "left" or k in values)
    assert got.columns == ["k", "i", "v"]
    assert Counter(map(tuple, got.collect())) == expected
    # The hot key's rows do not meet in one task: its partition is split while the job runs.
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        placed = joins.lookup_join(f, lookup, [("k", "kk")], how).withColumn("p", F.spark_partition_id())
        assert len({r.p for r in placed.collect() if r.k == "hot"}) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("salts", [1, 4])
def test_top_n(spark, salts):
    rng = random.Random(4)
    data = [("hot" if i % 3 else f"k{i % 5}", rng.random(), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, x double, i int").repartition(7)
    got = ranking.top_n_per_key(df, ["k"], [F.col("x"), F.col("i")], 5, salts)
    groups = defaultdict(list)
    for k, x, i in data:
        groups[k].append((x, i))
    assert {tuple(r) for r in got.collect()} == {(k, x, i) for k, g in groups.items() for x, i in sorted(g)[:5]}


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = ranking.top_n_per_key(df, ["k"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert "WindowGroupLimit" in lines[-1]


@pytest.mark.parametrize("n", [1_001, 30_000])
def test_large_top_n(spark, n):
    df = spark.range(0, 80_000, 1, 5).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 7 > 0, "x").alias("j"), "id")
    got = ranking.top_n_per_key(df, ["k", "j"], [F.col("id")], n)
    groups = defaultdict(list)
    for i in range(80_000):
        groups[i % 2, "x" if i % 7 else None].append(i)
    assert sorted(r.id for r in got.collect()) == sorted(i for g in groups.values() for i in g[:n])


def test_limits(spark):
    df = spark.range(5)
    assert [ranking.limited(df, x).count() for x in (None, 0, 2)] == [5, 5, 2]
    assert ranking.unlimited("None")
    children = spark.createDataFrame([("r", i, f"u{i}") for i in range(4)], "repo string, position int, user string")
    assert {r.user for r in ranking.first_children(children, "repo", "position", 2).collect()} == {"u0", "u1"}
    assert ranking.first_children(children, "repo", "position", 0).count() == 4


def test_best_first(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0), ("d", 2.0)], "k string, s double")
    assert [r.k for r in ranking.best_first(df, [F.col("s")], "k").collect()] == ["c", "d", "b", "a"]


def test_filters(spark):
    names = spark.createDataFrame([("x",), ("chromium",), (None,)], "name string")
    assert [r.name for r in filters.deny(names, "name", filters.NO_README).collect()] == ["x"]
    counts = spark.createDataFrame([(100, 3), (101, 3), (101, 2)], "lines_modified int, commit_count int")
    assert [tuple(r) for r in filters.active(counts).collect()] == [(101, 3)]
    mails = spark.createDataFrame([("a@x",), ("b[bot]@x",), ("c@github.com",), ("d@users.github.com.x",)], "e string")
    assert {r.e for r in filters.without_marks(mails, "e").collect()} == {"a@x", "d@users.github.com.x"}
    assert filters.nothing(mails).columns == ["e"] and filters.nothing(mails).count() == 0


def test_weighted_mean(spark):
    df = spark.createDataFrame([("a", 4, 2), ("a", None, 2), ("b", None, 3), ("c", 5, 0)], "k string, x int, w int")
    plain = dict(df.groupBy("k").agg(aggregates.weighted_mean("x", "w")).collect())
    known = dict(df.groupBy("k").agg(aggregates.weighted_mean("x", "w", skip_null=True)).collect())
    assert plain == {"a": 2.0, "b": None, "c": None} and known == {"a": 4.0, "b": None, "c": None}


def test_ordered_rows(spark):
    rng = random.Random(8)
    data = [("hot" if i % 3 else f"k{i % 4}", i, rng.choice(["x", "yy\n", None]), [f"f{i}"] if i % 2 else None) for i in range(900)]
    df = spark.createDataFrame(data, "k string, i int, t string, f array<string>").repartition(5)
    got = sorted(aggregates.ordered_rows(df, ["k"], ["i"]).collect(), key=lambda r: r.position)
    assert len({r.position for r in got}) == 900
    for key in {r[0] for r in data}:
        assert [tuple(r)[:4] for r in got if r.k == key] == sorted(r for r in data if r[0] == key)


def test_copies_spread_over_tasks(spark):
    df = spark.createDataFrame([("hot", 1, "x")] * 600, "k string, i int, t string").repartition(6)
    # Spark would put so few rows back into one task.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = aggregates.ordered_rows(df, ["k"], ["i"])
        assert rows.select(F.spark_partition_id()).distinct().count() > 1 and rows.count() == 600
        # One shuffle.
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_history_digest(spark):
    rng = random.Random(9)
    texts = ["one", "two words", "line\n", "a b\nc d\n", "", None, " ", "x\n\ny", " lead"]
    data = [(f"k{i % 7}", i, rng.choice(texts)) for i in range(700)]
    df = spark.createDataFrame(data, "k string, i int, t string").repartition(5)
    got = dict(aggregates.history_digest(df, ["k"], "t", ["i"], lines=12, words=15).collect())
    for key in got:
        whole = "".join(t or "" for k, _, t in sorted(data, key=lambda r: r[1]) if k == key)
        assert got[key] == " ".join("\n".join(whole.split("\n")[:12]).split()[:15])
    assert len(got) == 7
    # Neither one-word texts nor anything else behind the last line counts.
    late = [("k", i, "x y\n" if i < 20 else "update") for i in range(2_000)]
    df = spark.createDataFrame(late, "k string, i int, t string").repartition(4)
    assert aggregates.history_digest(df, ["k"], "t", ["i"], lines=12, words=1_000).first().t == " ".join(["x y"] * 12)


def test_history_digest_without_line_ends(spark):
    """Texts of many words and no line end: a cell holds what the result needs, not as many whole texts as it has words."""
    long = [(None if i % 2 else "k", i, f"w{i}a " * 3_000 + f"w{i}b") for i in range(200)]
    df = spark.createDataFrame(long, "k string, i int, t string").repartition(6)
    got = aggregates.history_digest(df, ["k"], "t", ["i"], lines=5, words=4_000)
    for r in got.collect():
        whole = "".join(t for k, _, t in long if k == r.k)
        assert r.t == " ".join(whole.split()[:4_000])
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    joined = [(1, i, "ab" if i % 3 else "c d") for i in range(300)]
    df = spark.createDataFrame(joined, "k int, i int, t string").repartition(3)
    whole = "".join(t for _, _, t in joined)
    assert aggregates.history_digest(df, ["k"], "t", ["i"], lines=5, words=40).first().t == " ".join(whole.split()[:40])


def test_first_items_and_distinct_list(spark):
    data = [("a", [f"f{i % 30:02}" for i in range(j, j + 9)]) for j in range(40)] + [("b", ["z", None, "z"]), ("c", [])]
    df = spark.createDataFrame(data, "k string, f array<string>")
    assert dict(aggregates.first_items(df, ["k"], "f", 5).collect()) == {"a": ["f00", "f01", "f02", "f03", "f04"], "b": ["z"]}
    assert dict(aggregates.distinct_list(df, ["k"], "f").collect()) == {"a": [f"f{i:02}" for i in range(30)], "b": ["z"], "c": []}


def hops_of(data, hops):
    """seed -> {key: hops} by breadth-first search."""
    rows = defaultdict(set)
    for r, k in data:
        rows[r].add(k)
    out = {}
    for seed in {k for _, k in data}:
        found, front = {seed: 0}, {seed}
        for h in range(1, hops + 1):
            front = {k for ks in rows.values() if ks & front for k in ks} - set(found)
            found.update(dict.fromkeys(front, h))
        out[seed] = found
    return out


def test_hop_limited_clusters(spark):
    rng = random.Random(8)
    data = [(f"r{rng.randrange(40)}", f"k{rng.randrange(60):02}") for _ in range(70)] + [(f"c{i}", f"z{j:02}") for i in range(8) for j in (i, i + 1)]
    df = spark.createDataFrame([*data, ("r1", None), ("r2", "shared"), ("r3", "shared")], "row string, key string")
    for hops in (0, 1, 2, 5):
        want = hops_of(data, hops)
        first = identity.first_key_within(df, ["row"], "key", hops, ["shared"])
        assert dict(map(tuple, first.collect())) == {s: min(f) for s, f in want.items()}
        seeds = spark.createDataFrame([("z00",), ("k07",), ("z00",), ("nobody",)], "key string")
        near = identity.keys_within(df, ["row"], "key", seeds, hops, ["shared"])
        assert sorted(map(tuple, near.collect())) == sorted((s, k, h) for s in ("z00", "k07") if s in want for k, h in want[s].items())
    # A row with very many keys is walked through its node.
    hub = spark.range(30_000).selectExpr("'hub' AS row", "concat('k', id) AS key").union(spark.createDataFrame([("x", "k5"), ("x", "a")], "row string, key string"))
    labels = identity.first_key_within(hub, ["row"], "key", 2)
    assert labels.groupBy("first_key").count().collect() == [("a", 30_001)]


def test_near_keys_in_blocks(spark, monkeypatch):
    """Blocks of any size, and those that are left to joins, give the same pairs."""
    rng = random.Random(9)
    data = [(f"r{rng.randrange(60)}", f"k{rng.randrange(90):02}") for _ in range(150)]
    df = spark.createDataFrame(data, "row string, key string")
    want = sorted((s, k, h) for s, found in hops_of(data, 3).items() for k, h in found.items())
    for bits, around in ((12, 4_000_000), (3, 4_000_000), (3, 60), (3, 0)):
        monkeypatch.setattr(identity, "_BLOCK_BITS", bits)
        monkeypatch.setattr(identity, "_AROUND", around)
        near = identity.keys_within(df, ["row"], "key", df.select("key"), 3)
        assert sorted(map(tuple, near.collect())) == want


def test_pairs_of_near_keys_are_not_written(spark):
    hub = spark.range(3_000).selectExpr("'hub' AS row", "concat('k', id) AS key")
    before = {f for f in Path(shared_dir(spark)).rglob("*.parquet")}
    near = identity.keys_within(hub, ["row"], "key", hub.select("key"), 2)
    counted = near.groupBy("seed").count().groupBy("count").agg(F.count("seed")).collect()
    assert counted == [(3_000, 3_000)]
    assert sum(f.stat().st_size for f in set(Path(shared_dir(spark)).rglob("*.parquet")) - before) < 1_000_000
