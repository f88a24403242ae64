"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected). One warm-up pass, then the median of
``BENCH_RUNS`` timed passes per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # executed views and their SQL siblings
    "courier_performance_view", "department_efficiency_view", "transport_utilization_view",
    "customer_satisfaction_view", "business_metrics", "department_staff_view", "transport_fleet_view",
    "geographical_coverage_view", "ml_model_performance_view",
    # quality gate and route validation (joins)
    "quality_report", "quality_checks", "validate_routes", "route_validation_summary",
    # sequences, windows, facts
    "previous_delivery", "courier_current_vs_previous", "logistics_anomalies", "time_series_features",
    "metric_anomalies", "department_facts", "transport_facts",
    # customer and marketing analytics
    "cohort_retention", "marketing_attribution", "rfm_segments", "customer_features", "web_kpis",
    "roi_by_channel", "executive_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from postlens.plans import catalog
    from postlens.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = catalog.queries()
    keys = [k for k in HEADLINE if k in qs]

    def run(k: str) -> float:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for k in keys:  # warm-up: JIT, file listing, metadata caches
        run(k)
    times = {k: round(statistics.median(run(k) for _ in range(runs)), 3) for k in keys}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
