"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query, of which the median counts. Every run
builds the query anew and computes its whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark import build_session  # noqa: E402
from tidemark.plans import all_queries  # noqa: E402

HEADLINE = [
    "serving_mart", "latest_per_key", "daily_summary", "star_revenue", "drill_across_daily", "site_correlation",
    "rollup_sites", "cube_sites", "number_rows", "running_mean", "moving_mean", "delta_to_previous",
    "rank_codes_with_ties", "deviation_all", "first_and_peak_of_day", "compare_to_baseline", "gap_report_hours",
    "build_fact", "upsert", "scd2_snapshot", "incremental_merge", "vault_link", "vault_satellite_changes",
    "run_checks", "flatten_payloads", "parse_reports", "latest_mart_rows", "stream_fact_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in only or HEADLINE:
        times = []
        for run in range(runs + 1):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:  # the first run warms up
                times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "headline query time, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "runs": runs, "cpus": int(cpus),
        "spark": spark.version, "shuffle_partitions": int(cpus), "driver_memory": "16g",
    }))


if __name__ == "__main__":
    main()
