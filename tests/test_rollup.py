import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from commitlens import schemas
from commitlens.plans import stages
from commitlens.streaming.rollup import Rollup


def commits(spark, rows):
    """(repo, name, email, day, added)"""
    full = [
        (r, "u", "o", str(i), n, e, d and dt.datetime(2024, 1, d), "m\n", ["f"], a, 0, a)
        for i, (r, n, e, d, a) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.COMMITS)


BATCHES = [
    [("r", "Zoe", "z@x", 5, 1), ("r", "Ann", "z@x", 7, 2), ("s", "Bo", "b@x", 1, 4)] * 3,
    [("r", "Al", "z@x", 2, 8), ("q", None, None, None, None)],
    [("t", f"n{i}", f"e{i}@x", 1 + i % 9, i) for i in range(60)] + [("q", None, None, 3, 1)],
]


@pytest.fixture
def kept(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "state"), buckets=8)

    def arrive(rows):
        commits(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "commits"))
        rollup.update(str(tmp_path / "commits"), str(tmp_path / "progress"))

    rollup.arrive = arrive
    return rollup


def ordered(df):
    return sorted(df.collect(), key=repr)


def test_appends_give_the_whole_rollup(spark, kept, tmp_path):
    for n in range(1, 4):
        kept.arrive(BATCHES[n - 1])
        whole = commits(spark, [r for b in BATCHES[:n] for r in b])
        assert ordered(kept.contributors()) == ordered(stages.extract_contributors(whole))
    # The name somebody signed with first counts, though it arrived later.
    assert {r.author_email: r.author_name for r in kept.contributors().collect()}["z@x"] == "Al"
    before = ordered(kept.contributors())
    kept.update(str(tmp_path / "commits"), str(tmp_path / "progress"))
    assert ordered(kept.contributors()) == before


def test_an_update_reads_new_files_and_touched_buckets_only(spark, kept, monkeypatch):
    read, states = [], []
    add, state = Rollup.add, Rollup.state
    monkeypatch.setattr(Rollup, "add", lambda self, df, batch: (read.append({r[0] for r in df.select(F.input_file_name()).distinct().collect()}), add(self, df, batch))[1])
    monkeypatch.setattr(Rollup, "state", lambda self, b=None, s=None: (states.append(b), state(self, b, s))[1])
    for rows in (BATCHES[2], BATCHES[0], [("s", "Bo", "b@x", 9, 1)]):
        kept.arrive(rows)
    assert [len(r) for r in read] == [1, 1, 1] and not (read[0] & read[1] | read[1] & read[2])
    assert len(states[0]) > 4 and len(states[1]) <= 2 and len(states[2]) == 1
    paths = kept.current()
    assert sum(f"/{2}-" in p for p in paths.values()) == 1


def test_a_batch_counts_once_and_a_dead_one_not_at_all(spark, kept, monkeypatch, tmp_path):
    kept.arrive(BATCHES[0])
    want = ordered(kept.contributors())
    # The same batch again, as after a restart before the stream noted it.
    kept.add(commits(spark, BATCHES[0]), 0)
    assert ordered(kept.contributors()) == want
    # Files without a manifest row are not read.
    stray = commits(spark, BATCHES[1])
    stages.commits_by_name(stray).write.parquet(str(tmp_path / "state" / "state" / "1-dead" / "bucket=0"))
    assert ordered(kept.contributors()) == want
    kept.add(commits(spark, []), 1)
    assert ordered(kept.contributors()) == want
    kept.arrive(BATCHES[0])
    folders = len(os.listdir(tmp_path / "state" / "state"))
    assert kept.drop_superseded() == 2 and folders
    assert {r.author_email: r.commit_count for r in kept.contributors().collect()} == {"z@x": 12, "b@x": 6}
