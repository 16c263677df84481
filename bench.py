"""Time the headline queries; prints one JSON line.

Each query runs once untimed (JVM warm-up) at the smallest scale, then
BENCH_RUNS times at BENCH_SF_DIR; the best time counts. Results go to the no-op
sink, so every column of every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dedupe_latest_lineitem",
    "extract_window_events",
    "stg_orders",
    "stg_order_items",
    "stg_inventory_snapshots",
    "scd2_initial_history",
    "scd2_incremental",
    "fact_order_asof",
    "fact_order_item_asof",
    "asof_join_shipments",
    "merge_upsert",
    "merge_moved_partition",
    "partition_overwrite",
    "mart_daily_sales",
    "mart_product_sales",
    "mart_customer_ltv",
    "mart_monthly_retention",
    "dq_unique_composite",
    "dq_relationships",
    "dq_suite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE

    from tidemark.registry.queries import REGISTRY
    from tidemark.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        {"spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    times = {}
    for name in names:
        if os.path.isdir(warm):
            run(name, warm)
        times[name] = round(min(run(name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
