"""Benchmark: time the headline reports at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: the headline set below), BENCH_REPEAT
(default 2, best of), BENCH_MODE (`stored`: build the warehouse once, timed as
`build_warehouse`, then run every report on it; `raw`: every report derives
the star from the driver tables itself). Each query runs to completion with the `noop` sink (every row
is produced, nothing is collected to the driver); a warm-up query runs first
so timings are warm-JVM. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # reports
    "revenue_kpis", "customer_metrics", "product_performance", "inventory_analytics",
    "marketing_roi_summary", "monthly_revenue", "customer_lifetime_value", "top_products",
    "inventory_turnover", "campaign_roi", "campaign_roi_deduplicated", "mom_growth", "qoq_growth",
    "cohort_retention", "rfm_segments", "dead_stock", "returned_products", "market_basket",
    "market_basket_keys", "fiscal_ytd_sales", "ending_inventory", "inventory_turnover_ratio",
    "net_revenue_ex_tax", "returns_liability", "rolling_12m_ltv",
    # build jobs
    "fact_sales", "fact_inventory", "fact_marketing", "scd2_build",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from duka.plans import registry
    from duka.session import ensure_checkpoint_dir, local_session

    mode = os.environ.get("BENCH_MODE", "stored")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="duka-bench")

    from duka.sources.store import build_warehouse
    from duka.sources.warehouse import Warehouse

    store_dir = None
    times: dict[str, float] = {}
    # warm-up: JVM, codegen caches, file listing (not timed)
    registry.run("monthly_revenue", spark, sf_dir).write.format("noop").mode("overwrite").save()
    if mode == "stored":
        # build once (the load job), then every report reads the star
        # under the session's checkpoint folder (shared storage on a cluster)
        store_dir = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-store-{uuid.uuid4().hex}"
        t0 = time.perf_counter()
        build_warehouse(Warehouse(spark, sf_dir), store_dir)
        times["build_warehouse"] = round(time.perf_counter() - t0, 3)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = registry.run(name, spark, sf_dir, store_dir=store_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        best = min(run(name) for _ in range(repeat))
        times[name] = round(best, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "state": "warm JVM, best of %d" % repeat,
        "mode": mode,
        "spark": spark.version,
        "python": platform.python_version(),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
