"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up code generation on the same data and is then timed whole,
all rows computed and none kept (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crossroads.plans.queries import QUERIES  # noqa: E402
from crossroads.session import local_session  # noqa: E402

HEADLINE = [
    "lane_priority_waits", "lane_decisions", "near_priorities", "cascade_waits", "validation_report", "feature_table",
    "scenario_text", "stratified_split", "variant_metrics", "latency_percentiles", "rolling_accuracy", "running_metrics",
    "subgroup_metrics", "perturb_speed", "flip_rates", "sensitivity", "chi_square", "mann_whitney_u", "ks_statistic",
    "asof_features", "trigger_per_user", "stream_hourly_metrics", "generated_scenarios", "lane_pairs_any_size",
    "near_priorities_any_size",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            for timed in (False, True):
                start = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if timed:
                    times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:  # the other figures are still wanted; the exit code tells
            failed[name] = f"{type(e).__name__}: {e}"[:300]
        print(f"{name} {times.get(name, 'FAILED')}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        **({"failed": failed} if failed else {}),
    }))
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
