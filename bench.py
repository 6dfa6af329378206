"""Time the headline queries: one JSON line with the median seconds per query.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3)
and BENCH_QUERIES (comma-separated names, or ``all``) adjust the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans import all_queries  # noqa: E402
from plumbline.session import local_session  # noqa: E402

HEADLINE = [
    "column_compare",
    "column_compare_repeated_keys",
    "column_compare_rows",
    "column_compare_by_key",
    "key_reconcile",
    "row_compare",
    "env_chain_compare",
    "stat_compare",
    "ab_data_quality",
    "consolidation_check",
    "consolidation_missing_union",
    "profile_dataset",
    "profile_dataset_string",
    "profile_columns",
    "summarize_grouped",
    "aggregate_measure",
    "find_duplicates",
    "date_distribution",
    "detect_drift",
    "check_unique",
    "check_relationship",
    "suggest_checks",
    "model_health",
    "semantic_version",
    "upstream_closure",
    "downstream_impact",
    "subgraph_edges",
    "migration_impact",
    "reference_edges_pages",
    "stage_time_off",
    "expand_leave_days",
    "fct_time_off_leave",
    "merge_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        # the first run compiles and warms the caches
        seconds[name] = round(statistics.median(taken[1:] or taken), 4)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 4)
    print(
        json.dumps(
            {
                "metric": "median warm seconds, summed over headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
