"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is planned and run to the end with its whole result written to the no-op sink. One
untimed pass of the flagship warms the JVM up. The store-backed queries include building the store
in the first of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quayside.session import local_session
from workloads.queries import QUERIES

HEADLINE = [
    "seasonal_shape", "shape_exclusions", "curve_points", "latest_complete_curve",
    "latest_points", "spread_by_position", "contango_days", "month_percent_rank",
    "revisions_per_month", "merge_current", "merge_stats", "silver_observations",
    "silver_rejected", "completeness_issues", "last_observations", "alert_crossings", "alert_log",
    "streamed_crossings", "staging_key_counts", "table_fingerprint", "shape_inputs_digest",
    "published_observations", "imported_versions", "warehouse_load_log", "named_spread",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    run = lambda name: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    run("contango_days")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        try:
            run(name)
        except Exception as error:  # one failing query must not hide the others
            print(f"{name}: {type(error).__name__}: {error}", file=sys.stderr)
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "failed": sorted(set(HEADLINE) - set(seconds)),
    }))


if __name__ == "__main__":
    main()
