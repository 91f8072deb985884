"""Time the headline queries once warm and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from commitlens.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = [
    "flagship",
    "contributors_rollup",
    "contributor_messages",
    "history_digest",
    "commit_log_roundtrip",
    "markup_format",
    "normalize_documents",
    "readme_pick",
    "keyword_topk",
    "agg_join_back",
    "skewed_lookup",
    "weighted_mean",
    "infer_scores",
    "identity_components",
    "merge_people",
    # These five read the final table, which the first run of the first of them writes.
    "packaged_top100",
    "present",
    "first_nonempty",
    "query_contract",
    "query_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        "/tmp/commitlens-shared",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            # Everything is computed and nothing is collected.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "sum of warm query times", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()
