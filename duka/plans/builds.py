"""Warehouse build jobs exposed as queries (their output tables)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duka.functions import fixed
from duka.functions.money import money
from duka.operators import asof, scd2
from duka.session import ensure_checkpoint_dir
from duka.sources.history import History
from duka.sources.warehouse import LINE_ORDER, Warehouse  # noqa: F401


def dim_date(w: Warehouse) -> DataFrame:
    return w.dim_date


def fiscal_calendar(w: Warehouse) -> DataFrame:
    return w.dim_date.select("date_key", "fiscal_month", "fiscal_quarter", "fiscal_year")


def localize_sales(w: Warehouse) -> DataFrame:
    return w.sales_lines.select(
        "order_id", "line_number", "product_key", "country", "local_currency",
        "exchange_rate_to_usd", "unit_price_local", "discount_amount_local",
        "tax_amount_local", "product_cost_local")


def sales_usd_measures(w: Warehouse) -> DataFrame:
    return w.sales_lines.select("order_id", "line_number", "product_key", "gross_revenue_usd",
                                "net_revenue_usd", "tax_usd", "profit_usd")


def sales_local_measures(w: Warehouse) -> DataFrame:
    """The first fact version: local-currency measures without FX."""
    gross = F.col("line_amount_local")
    net = money(gross - F.col("discount_amount_local"))
    return w.sales_lines.select(
        "order_id", "line_number", "product_key",
        gross.alias("gross_revenue_local"), net.alias("net_revenue_local"),
        money(net - F.col("line_cost_local")).alias("profit_local"))


FACT_SALES_COLUMNS = [
    "sales_fact_key", "order_id", "order_line_number", "date_key", "customer_key",
    "customer_version_key", "product_key",
    "location_key", "campaign_key", "status_key", "order_source", "quantity", "local_currency",
    "exchange_rate_to_usd", "unit_price_local", "discount_amount_local", "tax_amount_local",
    "product_cost_local", "gross_revenue_usd", "net_revenue_usd", "tax_usd", "profit_usd",
]

def fact_sales_full(w: Warehouse) -> DataFrame:
    """Every sales-line column plus the two keys (what the store writes)."""
    return w.fact_sales_keyed


def fact_sales(w: Warehouse) -> DataFrame:
    """The fact table with its surrogate and order-line keys."""
    return w.fact_sales_keyed.select(*FACT_SALES_COLUMNS)


def fact_inventory(w: Warehouse) -> DataFrame:
    return w.fact_inventory()


def campaign_cost_daily(w: Warehouse) -> DataFrame:
    return w.campaign_days


def fact_marketing(w: Warehouse) -> DataFrame:
    return w.fact_marketing


def customer_attributes(w: Warehouse) -> DataFrame:
    return w.customer_keys.select("customer_key", "customer_id", "gender", "age_group",
                                  "customer_segment")


def assign_campaign(w: Warehouse) -> DataFrame:
    """Each order goes to campaign (order id mod #campaigns) + 1; the
    campaign table (6 rows) is broadcast."""
    n = len(fixed.CAMPAIGNS)
    orders = w.table("orders").select(F.col("o_orderkey").alias("order_id"))
    keyed = orders.withColumn("campaign_key", (F.pmod("order_id", F.lit(n)) + 1).cast("int"))
    return keyed.join(F.broadcast(w.dim_campaign.select("campaign_key", "campaign_name")),
                      "campaign_key").select("order_id", "campaign_key", "campaign_name")


def scd2_versions(w: Warehouse) -> DataFrame:
    return w.customer_versions


def scd2_build(w: Warehouse) -> DataFrame:
    return scd2_versions(w).select("customer_key", "customer_id", "customer_version_key", "version",
                                   "customer_segment", "valid_from", "valid_to", "is_current")


def scd2_incremental(w: Warehouse) -> DataFrame:
    """The versions as two batches leave them (`sources/history.py`): the
    later years first, then the earlier ones, which are late by then."""
    root = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/customer-history-{uuid.uuid4().hex}"
    history = History(w.spark, root, "customer_key", "obs_date", "customer_segment", buckets=16)
    late = F.year("obs_date") < w.params["history_split_year"]
    history.apply(w.customer_observations.where(~late), "later years")
    history.apply(w.customer_observations.where(late), "earlier years")
    return w.with_version_keys(history.versions()).select(
        "customer_key", "customer_id", "customer_version_key", "version", "customer_segment",
        "valid_from", "valid_to", "is_current")


def scd2_current(w: Warehouse) -> DataFrame:
    return scd2.current_versions(scd2_versions(w)).select(
        "customer_key", "customer_id", "customer_segment", "valid_from")


def scd2_point_in_time(w: Warehouse) -> DataFrame:
    """Units and lines by order year and the tier valid on the order date."""
    # lines are summed per (customer, day) before the merge, so a
    # customer with a third of all lines brings one row per day to it
    facts = (w.sales_lines.groupBy("customer_key", "order_date")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")))
    j = asof.asof_merge(facts, "customer_key", "order_date", scd2_versions(w), "customer_key",
                        "valid_from", ["version", "customer_segment"]).where("version IS NOT NULL")
    return (j.groupBy(F.year("order_date").alias("year"), "customer_segment")
            .agg(F.sum("n").alias("lines"), F.sum("q").alias("units")))
