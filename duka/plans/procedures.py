"""Parameterised reports (the stored-procedure layer) as Python functions.

A parameter becomes a literal in the plan, so Catalyst pushes it to the
Parquet scan where the column allows it (order date range, customer key,
part type) instead of filtering after the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import TOTAL, pct, ratio, total
from duka.sources.warehouse import Warehouse


def monthly_revenue(w: Warehouse, target_year: int | None = None) -> DataFrame:
    year = int(target_year if target_year is not None else w.params["target_year"])
    excluded = fixed.status_keys("Cancelled", "Refunded")
    s = w.sales_in_year(year).where(~F.col("status_key").isin(*excluded))
    m = (s.groupBy(F.month("order_date").alias("month_number"))
         .agg(total("net_revenue_usd").alias("net_revenue_usd"),
              total("profit_usd").alias("total_profit_usd"))
         .withColumn("month_name", cal.month_name_of(F.lit(year), "month_number")))
    # the window runs over at most 12 aggregated rows
    prev = F.lag("net_revenue_usd", 1).over(Window.orderBy("month_number"))
    growth = F.col("net_revenue_usd") - prev
    return (m.select("month_number", "month_name", "net_revenue_usd", "total_profit_usd",
                     F.round(growth, 2).cast(TOTAL).alias("absolute_growth_usd"),
                     pct(growth, prev).alias("growth_rate_pct"))
            .orderBy("month_number").drop("month_number"))


def customer_lifetime_value(w: Warehouse, customer_id: int | None = None) -> DataFrame:
    cid = int(customer_id if customer_id is not None else w.params["customer_id"])
    # customer_id = customer_key + 1 + base: invert the rule so the key
    # predicate reaches the customer and orders scans
    key = cid - 1 - fixed.CUSTOMER_ID_BASE
    cust = (w.customer_keys.where(F.col("customer_key") == key)
            .where(F.col("customer_id") == cid)
            .join(F.broadcast(w.dim_location.select("location_key", "country")), "location_key"))
    # as the fact points at versions, lines of earlier ones are not counted
    per = w.current_lines(key).groupBy("customer_key").agg(
        F.countDistinct("order_id").alias("total_orders_placed"),
        F.sum("quantity").alias("total_items_purchased"),
        total("net_revenue_usd").alias("historical_spend_usd"),
        total("profit_usd").alias("net_contribution_profit_usd"))
    return cust.join(per, "customer_key").select(
        "customer_id", "customer_name", "customer_segment",
        F.col("country").alias("demography_country"),
        "total_orders_placed", "total_items_purchased", "historical_spend_usd",
        "net_contribution_profit_usd")


def top_products(w: Warehouse, top_n: int | None = None) -> DataFrame:
    n = int(top_n if top_n is not None else w.params["top_n"])
    s = w.sales_lines.where(F.col("status_key") == fixed.status_key("Completed"))
    per_product = s.groupBy("product_key").agg(
        F.sum("quantity").alias("u"), F.sum("net_revenue_usd").alias("r"),
        F.sum("profit_usd").alias("p"))
    g = (per_product.join(w.dim_product, "product_key")
         .groupBy("product_name", "category", "brand")
         .agg(F.sum("u").alias("total_units_sold"), total("r").alias("generated_revenue_usd"),
              total("p").alias("net_profit_usd")))
    # top-k is the feature: TakeOrderedAndProject keeps n rows per task
    return g.orderBy(F.desc("net_profit_usd"), "product_name", "category", "brand").limit(n)


def inventory_turnover(w: Warehouse, category: str | None = None) -> DataFrame:
    cat = category if category is not None else w.params["category"]
    products = w.dim_product.where(F.col("category") == cat)
    per_product = w.stock_totals(products).select(
        "product_key", F.col("stock_sold").alias("sold"), "days",
        (F.col("opening_stock") + F.col("closing_stock")).alias("oc"))
    g = (per_product.join(products, "product_key")
         .groupBy("category", "sub_category", "product_name")
         .agg(F.sum("sold").alias("total_units_sold"),
              F.sum(F.col("sold") * F.col("standard_cost")).alias("_cogs"),
              F.sum(F.col("oc") * F.col("standard_cost")).alias("_oc_value"),
              F.sum("days").alias("_n")))
    # AVG((open + close) / 2 * cost) = sum((open + close) * cost) / (2 n):
    # both outputs are exact quotients rounded once
    two_n = F.col("_n") * 2
    return g.select(
        "category", "sub_category", "product_name", "total_units_sold",
        F.round("_cogs", 2).cast(TOTAL).alias("cogs_usd"),
        ratio("_oc_value", two_n).alias("average_inventory_value_usd"),
        ratio(F.col("_cogs") * two_n, "_oc_value").alias("inventory_turnover_ratio")) \
        .orderBy(F.desc("inventory_turnover_ratio"))


def _campaign_day_frames(w: Warehouse, channel: str):
    campaigns = F.broadcast(w.dim_campaign.where(F.col("channel") == channel)
                            .select("campaign_key", "campaign_name", "channel"))
    fm = (w.fact_marketing.join(campaigns, "campaign_key")
          .groupBy("campaign_key", "campaign_name", "channel", "date_key")
          .agg(F.count(F.lit(1)).alias("n_m"), F.sum("impressions").alias("i"),
               F.sum("clicks").alias("c"), F.sum("conversions").alias("v"),
               F.sum("cost").alias("k")))
    sales = (w.sales_lines.join(campaigns.select("campaign_key"), "campaign_key")
             .groupBy("campaign_key", "date_key")
             .agg(F.count(F.lit(1)).alias("n_s"), F.sum("net_revenue_usd").alias("net")))
    return fm, sales


def _roi_columns(g: DataFrame) -> DataFrame:
    return g.select(
        "campaign_name", "channel", "impressions", "clicks",
        pct("clicks", "impressions", scale=3).alias("ctr_pct"),
        "conversions", "total_campaign_cost_usd", "attribution_revenue_usd",
        ratio(F.col("attribution_revenue_usd") - F.col("total_campaign_cost_usd"),
              "total_campaign_cost_usd").alias("return_on_investment_ratio")) \
        .orderBy(F.desc("return_on_investment_ratio"))


def campaign_roi(w: Warehouse, channel: str | None = None) -> DataFrame:
    """The report as written: campaign-day rows LEFT JOIN sales on campaign
    and day, so each campaign-day metric counts once per matching sale.

    The fan-out is computed, not materialised: both sides are aggregated to
    (campaign, day), a campaign-day row repeats max(1, sales that day) times
    and a sale repeats once per campaign-day row.
    """
    fm, sales = _campaign_day_frames(w, channel if channel is not None else w.params["channel"])
    j = fm.join(sales, ["campaign_key", "date_key"], "left")
    rep = F.coalesce(F.col("n_s"), F.lit(1))
    g = j.groupBy("campaign_name", "channel").agg(
        F.sum(F.col("i") * rep).alias("impressions"),
        F.sum(F.col("c") * rep).alias("clicks"),
        F.sum(F.col("v") * rep).alias("conversions"),
        total(F.col("k") * rep).alias("total_campaign_cost_usd"),
        F.coalesce(total(F.col("net") * F.col("n_m")), F.lit(0).cast(TOTAL))
        .alias("attribution_revenue_usd"))
    return _roi_columns(g)


def campaign_roi_deduplicated(w: Warehouse, channel: str | None = None) -> DataFrame:
    """Same report with both sides at campaign-day grain before the join,
    so marketing metrics count once and sales once."""
    fm, sales = _campaign_day_frames(w, channel if channel is not None else w.params["channel"])
    j = fm.join(sales, ["campaign_key", "date_key"], "left")
    g = j.groupBy("campaign_name", "channel").agg(
        F.sum("i").alias("impressions"), F.sum("c").alias("clicks"),
        F.sum("v").alias("conversions"), total("k").alias("total_campaign_cost_usd"),
        F.coalesce(total("net"), F.lit(0).cast(TOTAL)).alias("attribution_revenue_usd"))
    return _roi_columns(g)
