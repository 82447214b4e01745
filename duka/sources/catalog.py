"""Named views: expose warehouse tables and reports to `spark.sql`.

The load scripts define reporting views over the star; here each warehouse
table and each report DataFrame is registered as a temporary view, so SQL
users can write `SELECT * FROM revenue_kpis WHERE year = 2000` and Catalyst
still plans the whole thing (the view is the lazy plan, not a result).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from duka.sources.warehouse import Warehouse

TABLES = ["dim_date", "dim_location", "dim_customer", "dim_product", "dim_campaign",
          "dim_status", "customer_versions", "sales_lines", "fact_marketing", "campaign_days"]

# reports whose plans run a job when defined (the distributed numbering
# writes its lineage-cut table; the incremental load runs its stream); they
# are registered only when asked for by name
EAGER = {"fact_sales", "rfm_segments", "window_ntile", "surrogate_keys", "surrogate_keys_reload", "order_line_number",
         "scd2_point_in_time", "scd2_incremental", "star_row_counts",
         "fact_marketing_incremental"}


def register_tables(w: Warehouse, prefix: str = "") -> list[str]:
    for name in TABLES:
        getattr(w, name).createOrReplaceTempView(prefix + name)
    w.fact_inventory().createOrReplaceTempView(f"{prefix}fact_inventory")
    return TABLES + ["fact_inventory"]


def register_reports(w: Warehouse, names: list[str] | None = None, prefix: str = "") -> list[str]:
    from duka.plans.registry import PLANS
    chosen = names if names is not None else [n for n in PLANS if n not in EAGER]
    for name in chosen:
        PLANS[name](w).createOrReplaceTempView(prefix + name)
    return list(chosen)


def register_all(spark: SparkSession, sf_dir: str, store_dir: str | None = None) -> list[str]:
    from duka.plans.registry import warehouse
    w = warehouse(spark, sf_dir, store_dir)
    return register_tables(w) + register_reports(w)
