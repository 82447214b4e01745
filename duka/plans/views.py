"""Reporting views: revenue KPIs, customer, product, inventory and marketing.

Pattern used throughout: aggregate the fact by the dimension key first
(partial aggregation before any shuffle), then join the dimension on that
much smaller result, then aggregate by the dimension attributes. A large
dimension is therefore never joined at fact grain, and a hot key costs one
row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import TOTAL, pct, ratio, total
from duka.sources.warehouse import Warehouse


def revenue_kpis(w: Warehouse) -> DataFrame:
    excluded = fixed.status_keys("Cancelled", "Refunded")
    s = w.sales_lines.where(~F.col("status_key").isin(*excluded))
    # calendar attributes are functions of the order date (the calendar
    # covers every order year), so no per-row dimension lookup is needed
    per_order = (s.groupBy(F.year("order_date").alias("year"),
                           F.month("order_date").alias("month_number"), "order_id")
                 .agg(F.sum("gross_revenue_usd").alias("g"), F.sum("net_revenue_usd").alias("n"),
                      F.sum("profit_usd").alias("p")))
    g = per_order.groupBy("year", "month_number").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("g").alias("gross_revenue_usd"), total("n").alias("net_revenue_usd"),
        total("p").alias("total_profit_usd"))
    return g.select("year", cal.month_name_of("year", "month_number").alias("month_name"),
                    "total_orders", "gross_revenue_usd", "net_revenue_usd",
                    "total_profit_usd",
                    pct("total_profit_usd", "net_revenue_usd").alias("profit_margin_pct"),
                    ratio("net_revenue_usd", "total_orders").alias("aov_usd"))


def customer_metrics(w: Warehouse) -> DataFrame:
    s = w.sales_lines.where(F.col("status_key") == fixed.status_key("Completed"))
    per_customer = s.groupBy("customer_key").agg(F.sum("quantity").alias("items"),
                                                 F.sum("net_revenue_usd").alias("net"))
    joined = per_customer.join(w.customer_keys.select("customer_key", "customer_segment"),
                               "customer_key")
    g = joined.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("items").alias("total_items_purchased"),
        total("net").alias("total_revenue_usd"))
    return g.withColumn("clv_usd", ratio("total_revenue_usd", "active_customers"))


def product_performance(w: Warehouse) -> DataFrame:
    returned = fixed.status_key("Returned")
    s = w.sales_lines
    per_product = s.groupBy("product_key").agg(
        F.sum("quantity").alias("units"), F.sum("net_revenue_usd").alias("net"),
        F.sum("profit_usd").alias("profit"),
        F.sum(F.when(F.col("status_key") == returned, F.col("quantity")).otherwise(0))
        .alias("returned"))
    joined = per_product.join(w.dim_product, "product_key")
    g = joined.groupBy("category", "sub_category", "product_name", "brand").agg(
        F.sum("units").alias("units_sold"), total("net").alias("net_revenue_usd"),
        total("profit").alias("total_profit_usd"), F.sum("returned").alias("_returned"))
    return g.withColumn("return_rate_pct", pct("_returned", "units_sold")).drop("_returned")


def inventory_analytics(w: Warehouse) -> DataFrame:
    per_product = w.stock_totals().select(
        "product_key", F.col("opening_stock").alias("o"), F.col("stock_sold").alias("s"),
        F.col("closing_stock").alias("c"))
    joined = per_product.join(w.dim_product, "product_key")
    g = joined.groupBy("category", "product_name").agg(
        F.sum("o").alias("total_opening_stock"), F.sum("s").alias("total_units_sold"),
        F.sum("c").alias("current_stock_on_hand"),
        F.sum(F.col("c") * F.col("standard_cost")).alias("_value"))
    label = (F.when(F.col("total_units_sold") == 0, fixed.STOCK_DEAD)
             .when(F.col("current_stock_on_hand") > F.col("total_units_sold") * fixed.OVERSTOCK_FACTOR,
                   fixed.STOCK_OVER)
             .otherwise(fixed.STOCK_OK))
    return g.select("category", "product_name", "total_opening_stock", "total_units_sold",
                    "current_stock_on_hand",
                    F.round("_value", 2).cast(TOTAL).alias("inventory_value_usd"),
                    label.alias("stock_health_status"))


def marketing_roi_summary(w: Warehouse) -> DataFrame:
    fm = w.fact_marketing
    per_campaign = fm.groupBy("campaign_key").agg(
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
        total("cost").alias("total_campaign_cost_usd"))
    joined = per_campaign.join(F.broadcast(w.dim_campaign), "campaign_key")
    g = joined.groupBy("campaign_name", "channel").agg(
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_conversions").alias("total_conversions"),
        total("total_campaign_cost_usd").alias("total_campaign_cost_usd"))
    return g.withColumn("cac_usd", ratio("total_campaign_cost_usd", "total_conversions"))
