"""Benchmark the headline queries.

Runs each query over the tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Every query is executed in full with the ``noop`` sink (no driver collect).
Each query runs twice; ``queries`` holds the warm (second) run, ``cold`` the
first run (code generation, Python worker start-up), ``value`` the warm total.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracewise.registry import load_all  # noqa: E402
from tracewise.session import get_session  # noqa: E402

HEADLINE = [
    "top2_worst_services",      # flagship: stats -> 3-sigma -> rates -> top 5
    "det2_multi_metric_features",
    "det3_feature_zscores",
    "pql9_mesh_health",
    "rca9_latency_report",
    "cor1_corr_matrix",
    "cor5_lagged_corr_edges",
    "det5_iqr_anomalies",
    "det13_traffic_features",
    "det7_forest_score",
    "rca6_edge_candidates",
    "rca3_worst_services",      # a whole train-and-score cycle
    "det8_oneclass_boundary",
    "det10_group_summary",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app="tracewise-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "8g"})
    qs = load_all()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in names if any(a in n for a in sys.argv[1:])]
    # warm-up: JVM start, class loading, Python workers
    qs["agg1_bucket_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name in names:
        for run in (cold, warm):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            run[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(warm.values()), 3)
    print(json.dumps({"metric": "headline_queries_total_sec", "value": total, "unit": "sec",
                      "queries": warm, "cold": cold, "cold_total": round(sum(cold.values()), 3),
                      "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
