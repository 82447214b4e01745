"""Analytics reports: growth, cohorts, RFM, dead stock, returns, baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import TOTAL, pct, total
from duka.operators import antijoin, cutpoints, numbering, pairs
from duka.sources.warehouse import Warehouse

COMPLETED = fixed.status_key("Completed")
RETURNED = fixed.status_key("Returned")


def _completed(w: Warehouse) -> DataFrame:
    return w.sales_lines.where(F.col("status_key") == COMPLETED)


def mom_growth(w: Warehouse) -> DataFrame:
    m = (_completed(w).groupBy(F.year("order_date").alias("year"),
                               F.month("order_date").alias("month_number"))
         .agg(total("net_revenue_usd").alias("current_month_revenue_usd"))
         .withColumn("month_name", cal.month_name_of("year", "month_number")))
    # one row per month: the unpartitioned window is over a few dozen rows
    prev = F.lag("current_month_revenue_usd", 1).over(Window.orderBy("year", "month_number"))
    cur = F.col("current_month_revenue_usd")
    return m.select(
        "year", "month_number", "month_name", "current_month_revenue_usd",
        F.coalesce(prev, F.lit(0)).cast(TOTAL).alias("previous_month_revenue_usd"),
        F.round(cur - prev, 2).cast(TOTAL).alias("revenue_variance_usd"),
        pct(cur - prev, prev).alias("mom_growth_rate_pct")) \
        .orderBy("year", "month_number").drop("month_number")


def qoq_growth(w: Warehouse) -> DataFrame:
    q = (_completed(w).groupBy(F.year("order_date").alias("year"),
                               F.quarter("order_date").alias("quarter"))
         .agg(total("net_revenue_usd").alias("current_quarter_revenue_usd")))
    prev = F.lag("current_quarter_revenue_usd", 1).over(Window.orderBy("year", "quarter"))
    cur = F.col("current_quarter_revenue_usd")
    return q.select(
        "year", "quarter",
        F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("financial_quarter"),
        "current_quarter_revenue_usd",
        F.coalesce(prev, F.lit(0)).cast(TOTAL).alias("previous_quarter_revenue_usd"),
        pct(cur - prev, prev).alias("qoq_growth_rate_pct")) \
        .orderBy("year", "quarter").drop("quarter")


def cohort_retention(w: Warehouse) -> DataFrame:
    """Cohort = month of a customer's first purchase (any status); activity
    = completed purchases. One pass of the fact: it is aggregated to (customer, month), then to
    a customer's first month and set of active months (at most one entry per calendar month)."""
    mi = cal.month_index(F.year("order_date"), F.month("order_date"))
    per_month = w.sales_lines.groupBy("customer_key", mi.alias("mi")).agg(
        F.max(F.col("status_key") == COMPLETED).alias("done"))
    per_customer = per_month.groupBy("customer_key").agg(
        F.min("mi").alias("first"), F.collect_list(F.when(F.col("done"), F.col("mi"))).alias("months")) \
        .where(F.size("months") > 0)
    g = per_customer.groupBy("first").agg(F.count(F.lit(1)).alias("cohort_size"), *[
        F.count_if(F.array_contains("months", F.col("first") + k)).alias(name) for k, name in enumerate(
            ("month_0_active", "month_1_retained", "month_2_retained", "month_3_retained"))])
    cohort = F.format_string("%04d-%02d", F.floor(F.col("first") / 12).cast("int"), F.col("first") % 12 + 1)
    return g.select(cohort.alias("cohort"), "cohort_size",
                    "month_0_active", "month_1_retained", "month_2_retained", "month_3_retained",
                    pct("month_1_retained", "cohort_size").alias("month_1_retention_rate_pct")) \
        .orderBy("cohort")


def rfm_segments(w: Warehouse, as_of: str | None = None) -> DataFrame:
    """Recency / frequency / monetary quartiles by exact cut points
    (`operators/cutpoints.py`): no sort, no window, no join back; ties are
    broken by customer key."""
    as_of = as_of if as_of is not None else w.params["rfm_as_of"]
    per_order = (_completed(w).groupBy("customer_key", "order_id")
                 .agg(F.max("order_date").alias("d"), F.sum("net_revenue_usd").alias("n")))
    raw = per_order.groupBy("customer_key").agg(
        F.datediff(F.lit(as_of).cast("date"), F.max("d")).alias("recency_days"),
        F.count(F.lit(1)).alias("order_frequency"),
        total("n").alias("total_monetary_value_usd"))
    # each refinement scans the written per-customer table once
    raw = numbering.write_table(raw.where(F.col("customer_key").isNotNull()))
    m = cutpoints.ntiles(raw, 4, {"r_score": -F.col("recency_days"), "f_score": F.col("order_frequency"),
                                  "m_score": F.col("total_monetary_value_usd") * 100}, "customer_key")
    R, Fs, M = F.col("r_score"), F.col("f_score"), F.col("m_score")
    label = (F.when((R >= 3) & (Fs >= 3) & (M >= 3), fixed.RFM_CHAMPIONS)
             .when((R <= 2) & (Fs >= 3), fixed.RFM_AT_RISK)
             .when((R >= 3) & (Fs == 1), fixed.RFM_PROMISING)
             .otherwise(fixed.RFM_HIBERNATING))
    return (m.join(w.customer_keys.select("customer_key", "customer_id", "customer_name"),
                   "customer_key")
            .select("customer_id", "customer_name", "recency_days", "order_frequency",
                    "total_monetary_value_usd", label.alias("actionable_marketing_segment"))
            .orderBy(F.desc("total_monetary_value_usd")))


def recently_sold(w: Warehouse, cutoff_key: int) -> DataFrame:
    k = int(cutoff_key)
    start = f"{k // 10000:04d}-{k // 100 % 100:02d}-{k % 100:02d}"
    # date_key >= k  <=>  order date >= start: the bound reaches the scan
    return w.sales_from(start).where(F.col("date_key") >= k).select("product_key")


def dead_stock(w: Warehouse, cutoff_key: int | None = None) -> DataFrame:
    cutoff = int(cutoff_key if cutoff_key is not None else w.params["dead_stock_cutoff_key"])
    unsold = antijoin.not_in(w.dim_product, "product_key", recently_sold(w, cutoff), "product_key")
    per_product = w.stock_totals().select("product_key", F.col("closing_stock").alias("c"))
    g = (per_product.join(unsold, "product_key")
         .groupBy("product_id", "product_name", "category", "brand")
         .agg(F.sum("c").alias("unsold_units_on_hand"),
              F.sum(F.col("c") * F.col("standard_cost")).alias("_v")))
    return (g.where(F.col("unsold_units_on_hand") > 0)
            .withColumn("tied_up_capital_usd", F.round("_v", 2).cast(TOTAL)).drop("_v")
            .orderBy(F.desc("tied_up_capital_usd")))


def returned_products(w: Warehouse) -> DataFrame:
    st, q = F.col("status_key"), F.col("quantity")
    per_product = w.sales_lines.groupBy("product_key").agg(
        F.sum(F.when(st == COMPLETED, q).otherwise(0)).alias("kept"),
        F.sum(F.when(st == RETURNED, q).otherwise(0)).alias("ret"),
        F.sum(q).alias("units"),
        F.sum(F.when(st == RETURNED, F.col("net_revenue_usd")).otherwise(0)).alias("lost"))
    g = (per_product.join(w.dim_product, "product_key")
         .groupBy("product_name", "category")
         .agg(F.sum("kept").alias("total_units_kept"), F.sum("ret").alias("total_units_returned"),
              F.sum("units").alias("_units"), F.sum("lost").alias("_lost")))
    return (g.where(F.col("total_units_returned") > 0)
            .select("product_name", "category", "total_units_kept", "total_units_returned",
                    pct("total_units_returned", "_units").alias("return_rate_pct"),
                    F.round("_lost", 2).cast(TOTAL).alias("lost_revenue_usd"))
            .orderBy(F.desc("return_rate_pct"), F.desc("lost_revenue_usd")))


def market_basket(w: Warehouse, min_pairs: int | None = None) -> DataFrame:
    """Line pairs of completed orders with product key A < B, grouped by the
    category and name of both products; pairs seen more than `min_pairs`."""
    threshold = int(min_pairs if min_pairs is not None else w.params["basket_min_pairs"])
    counts = pairs.pair_counts(_completed(w), "order_id", "product_key")
    p = w.dim_product.select("product_key", "category", "product_name")
    a = p.select(F.col("product_key").alias("item_a"), F.col("category").alias("product_a_category"),
                 F.col("product_name").alias("product_a_name"))
    b = p.select(F.col("product_key").alias("item_b"), F.col("category").alias("product_b_category"),
                 F.col("product_name").alias("product_b_name"))
    g = (counts.join(a, "item_a").join(b, "item_b")
         .groupBy("product_a_category", "product_a_name", "product_b_category", "product_b_name")
         .agg(F.sum("times").alias("times_purchased_together")))
    return g.where(F.col("times_purchased_together") > threshold) \
        .orderBy(F.desc("times_purchased_together"))


def market_basket_keys(w: Warehouse) -> DataFrame:
    counts = pairs.pair_counts(w.sales_lines, "order_id", "product_key")
    return counts.select(F.col("item_a").alias("product_a"), F.col("item_b").alias("product_b"),
                         F.col("times").alias("times_purchased_together"))
