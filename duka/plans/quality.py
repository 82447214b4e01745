"""Data-quality reports: orphan references, duplicate keys, null counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duka.operators import quality
from duka.sources.warehouse import Warehouse

# (check name, child table, child key, parent table, parent key); table names
# starting with "w:" are warehouse attributes, others are driver tables.
ORPHAN_CHECKS = [
    ("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey -> supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey -> nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey -> region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("region.r_name -> market_policy", "region", "r_name", "w:market_policy", "country"),
    ("fact_sales.date_key -> dim_date", "w:sales_lines", "date_key", "w:dim_date", "date_key"),
    ("fact_sales.status_key -> dim_status", "w:sales_lines", "status_key", "w:dim_status",
     "status_key"),
    ("fact_sales.campaign_key -> dim_campaign", "w:sales_lines", "campaign_key", "w:dim_campaign",
     "campaign_key"),
    ("fact_marketing.campaign_key -> dim_campaign", "w:fact_marketing", "campaign_key",
     "w:dim_campaign", "campaign_key"),
]

KEY_CHECKS = [
    ("part(p_partkey)", "part", ["p_partkey"]),
    ("customer(c_custkey)", "customer", ["c_custkey"]),
    ("orders(o_orderkey)", "orders", ["o_orderkey"]),
    ("lineitem(l_orderkey, l_linenumber)", "lineitem", ["l_orderkey", "l_linenumber"]),
    ("dim_date(date_key)", "w:dim_date", ["date_key"]),
    ("fact_marketing(date_key, campaign_key)", "w:fact_marketing", ["date_key", "campaign_key"]),
]

NULL_CHECK_COLUMNS = {
    "fact_sales": ["order_id", "line_number", "date_key", "customer_key", "product_key",
                   "location_key", "campaign_key", "status_key", "order_source", "quantity",
                   "local_currency", "exchange_rate_to_usd", "unit_price_local",
                   "discount_amount_local", "tax_amount_local", "product_cost_local",
                   "gross_revenue_usd", "net_revenue_usd", "tax_usd", "profit_usd"],
    "dim_customer": ["customer_key", "customer_id", "customer_name", "gender", "age_group",
                     "location_key", "signup_date", "customer_segment", "valid_from",
                     "valid_to", "is_current"],
}


def _resolve(w: Warehouse, name: str) -> DataFrame:
    if name.startswith("w:"):
        return getattr(w, name[2:])
    return w.table(name)


def dq_orphans(w: Warehouse) -> DataFrame:
    return quality.orphan_counts(ORPHAN_CHECKS, lambda name: _resolve(w, name))


def dq_duplicate_keys(w: Warehouse) -> DataFrame:
    return quality.union_all([
        quality.duplicate_keys(check, _resolve(w, table), keys)
        for check, table, keys in KEY_CHECKS])


def dq_null_counts(w: Warehouse) -> DataFrame:
    frames = {"fact_sales": w.sales_lines, "dim_customer": w.dim_customer}
    return quality.union_all([
        quality.null_counts(t, frames[t].select(*cols)) for t, cols in NULL_CHECK_COLUMNS.items()])
