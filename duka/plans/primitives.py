"""Small queries that each exercise one construct of the warehouse SQL
(inline rows, NOT IN, modulo, star/snowflake/left/dense/self/range joins,
anti joins, aggregates, pivot, windows, numbering, sampling, functions)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import money, ratio, round_money, total
from duka.operators import antijoin, numbering, pairs, ranges, sampling
from duka.plans.analytics import recently_sold
from duka.session import ensure_checkpoint_dir
from duka.sources.keys import KeyMap
from duka.sources.warehouse import Warehouse


def _calendar(w: Warehouse, *cols: str) -> DataFrame:
    return F.broadcast(w.dim_date.select("date_key", *cols))


def src_status_values(w: Warehouse) -> DataFrame:
    """The inline status rows, each with its number of sales lines."""
    per_status = w.sales_lines.groupBy("status_key").agg(F.count(F.lit(1)).alias("line_count"))
    return (w.dim_status.join(per_status, "status_key", "left")
            .select("status_key", "status_name",
                    F.coalesce("line_count", F.lit(0)).alias("line_count")))


def filter_status_not_in(w: Warehouse) -> DataFrame:
    names = ["Cancelled", "Refunded"]
    s = w.sales_lines.join(F.broadcast(w.dim_status), "status_key") \
        .where(~F.col("status_name").isin(*names))
    return s.agg(F.count(F.lit(1)).alias("line_count"),
                 total("net_revenue_usd").alias("net_revenue_usd"))


def filter_modulo(w: Warehouse, lo: int = 1996, hi: int = 2000) -> DataFrame:
    d = w.dim_date.where((F.col("day_number") % 4 == 0) & F.col("year").between(lo, hi))
    return (w.sales_lines.join(F.broadcast(d.select("date_key", "year")), "date_key")
            .groupBy("year").agg(F.count(F.lit(1)).alias("line_count")))


def join_star(w: Warehouse) -> DataFrame:
    per = w.sales_lines.groupBy("product_key", "date_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"))
    return (per.join(w.dim_product.select("product_key", "category"), "product_key")
            .join(_calendar(w, "year"), "date_key")
            .groupBy("category", "year")
            .agg(F.sum("n").alias("line_count"), F.sum("q").alias("units")))


def join_snowflake(w: Warehouse) -> DataFrame:
    """fact -> customer -> location, aggregated per customer before the hops."""
    per = w.sales_lines.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"))
    cust = w.customer_keys.select("customer_key", "location_key")
    loc = F.broadcast(w.dim_location.select("location_key", "country"))
    return (per.join(cust, "customer_key").join(loc, "location_key")
            .groupBy("country").agg(F.sum("n").alias("line_count"), F.sum("q").alias("units")))


def join_left_multi(w: Warehouse) -> DataFrame:
    """Campaign-days LEFT JOIN sales-days on (campaign, day)."""
    sales_days = w.sales_lines.groupBy("campaign_key", "date_key").agg(
        F.count(F.lit(1)).alias("lines"))
    j = w.fact_marketing.select("campaign_key", "date_key").join(
        sales_days, ["campaign_key", "date_key"], "left")
    return j.groupBy("campaign_key").agg(
        F.count(F.lit(1)).alias("campaign_days"),
        F.count("lines").alias("matched_days"),
        F.count_if(F.col("lines").isNull()).alias("unmatched_days"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("matched_lines"))


def join_cross_dense(w: Warehouse) -> DataFrame:
    """Dense (day x product) grid over the whole calendar with zero-filled
    units, summarised per month. The grid is kept as runs of days
    (`ranges.value_runs`) and its cells are counted by the runs' lengths, so
    neither a cross join nor a row per product and day is made."""
    products = w.dim_product.select("product_key")
    # the calendar bounds are scalar subqueries (one global aggregate each)
    lo = w.date_bounds.select("lo").scalar()
    hi = w.date_bounds.select("hi").scalar()
    sold = w.sales_lines.groupBy("product_key", "order_date").agg(F.sum("quantity").alias("sold"))
    runs = ranges.value_runs(products, "product_key", sold, "order_date", "sold", lo, hi)
    units = F.coalesce("sold", F.lit(0))
    return (ranges.run_months(runs).groupBy(F.year("month").alias("year"), F.month("month").alias("month_number"))
            .agg(F.sum(F.col("days").cast("bigint")).alias("grid_cells"),
                 F.sum(F.when(units == 0, F.col("days")).otherwise(0).cast("bigint")).alias("zero_cells"),
                 F.sum(units).alias("units")))


def join_self_theta(w: Warehouse) -> DataFrame:
    """Per order: number of line pairs whose product key A < B."""
    return pairs.pairs_per_basket(w.sales_lines, "order_id", "product_key", "pair_count")


def join_range_dates(w: Warehouse) -> DataFrame:
    """Active campaigns per calendar day: ranges are cut into power-of-two
    cells of days and joined on the cell (`ranges.interval_join`)."""
    days = ranges.interval_join(w.dim_date.select("full_date", "date_key"), "full_date",
                                w.dim_campaign.select("start_date", "end_date"), "start_date", "end_date")
    return days.groupBy("date_key").agg(F.count(F.lit(1)).alias("active_campaigns"))


def _unsold_products(w: Warehouse, how: str) -> DataFrame:
    cutoff = int(w.params["dead_stock_cutoff_key"])
    recent = recently_sold(w, cutoff)
    products = w.dim_product.select("product_key", "product_name")
    if how == "not_in":
        return antijoin.not_in(products, "product_key", recent, "product_key")
    return antijoin.anti_join(products, "product_key", recent, "product_key")


def anti_join_not_in(w: Warehouse) -> DataFrame:
    return _unsold_products(w, "not_in")


def anti_join_left_anti(w: Warehouse) -> DataFrame:
    return _unsold_products(w, "left_anti")


def _with_segment(w: Warehouse, df: DataFrame) -> DataFrame:
    return df.join(w.customer_keys.select("customer_key", "customer_segment"), "customer_key")


def agg_count_distinct(w: Warehouse) -> DataFrame:
    per_order = w.sales_lines.groupBy("customer_key", "order_id").agg(F.count(F.lit(1)).alias("n"))
    per_customer = per_order.groupBy("customer_key").agg(F.count(F.lit(1)).alias("orders"))
    return (_with_segment(w, per_customer).groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("distinct_customers"),
                 F.sum("orders").alias("distinct_orders")))


def agg_conditional_sum(w: Warehouse) -> DataFrame:
    st = F.col("status_key")
    per = w.sales_lines.groupBy("product_key").agg(
        F.sum(F.when(st == fixed.status_key("Returned"), F.col("quantity")).otherwise(0)).alias("r"),
        F.sum(F.when(st == fixed.status_key("Completed"), F.col("net_revenue_usd"))
              .otherwise(0)).alias("c"))
    return (per.join(w.dim_product.select("product_key", "category"), "product_key")
            .groupBy("category").agg(F.sum("r").alias("returned_units"),
                                     total("c").alias("completed_net_usd")))


def agg_min_max_date(w: Warehouse) -> DataFrame:
    per = w.sales_lines.groupBy("customer_key").agg(F.min("order_date").alias("lo"),
                                                    F.max("order_date").alias("hi"))
    return (_with_segment(w, per).groupBy("customer_segment")
            .agg(F.min("lo").alias("first_order_date"), F.max("hi").alias("last_order_date")))


def agg_avg_expression(w: Warehouse) -> DataFrame:
    """Average net revenue per line by category, the exact quotient rounded
    once (sum / count)."""
    per = w.sales_lines.groupBy("product_key").agg(F.sum("net_revenue_usd").alias("s"),
                                                   F.count(F.lit(1)).alias("n"))
    g = (per.join(w.dim_product.select("product_key", "category"), "product_key")
         .groupBy("category").agg(total("s").alias("_s"), F.sum("n").alias("_n")))
    return g.select("category", ratio("_s", "_n").alias("avg_net_revenue_usd"))


def agg_having(w: Warehouse, min_lines: int = 300) -> DataFrame:
    per = w.sales_lines.groupBy("product_key").agg(F.count(F.lit(1)).alias("n"),
                                                   F.sum("net_revenue_usd").alias("s"))
    g = (per.join(w.dim_product.select("product_key", "category", "brand"), "product_key")
         .groupBy("category", "brand").agg(F.sum("n").alias("line_count"),
                                           total("s").alias("net_revenue_usd")))
    return g.where(F.col("line_count") > min_lines)


def agg_pivot_months(w: Warehouse) -> DataFrame:
    """Units per year with one column per quarter (pivot with fixed values,
    a single aggregation)."""
    s = w.sales_lines.select(F.year("order_date").alias("year"),
                             F.quarter("order_date").alias("quarter"), "quantity")
    p = s.groupBy("year").pivot("quarter", [1, 2, 3, 4]).agg(F.sum("quantity"))
    return p.select("year", *[F.col(str(q)).alias(f"q{q}_units") for q in (1, 2, 3, 4)])


def window_lag(w: Warehouse) -> DataFrame:
    m = (w.sales_lines.groupBy(F.year("order_date").alias("year"),
                               F.month("order_date").alias("month_number"))
         .agg(F.sum("quantity").alias("units")))
    prev = F.lag("units", 1).over(Window.orderBy("year", "month_number"))
    return m.withColumn("previous_units", prev)


def window_ntile(w: Warehouse) -> DataFrame:
    per_order = w.sales_lines.groupBy("customer_key", "order_id").agg(F.count(F.lit(1)).alias("n"))
    per = per_order.groupBy("customer_key").agg(F.count(F.lit(1)).alias("order_count"))
    return numbering.ntile(per, 4, [F.col("order_count"), F.col("customer_key")], "quartile")


def order_line_number(w: Warehouse) -> DataFrame:
    from duka.plans.builds import LINE_ORDER
    sizes = w.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count(F.lit(1)).alias("n"))
    n = numbering.number_within_groups(w.sales_lines, ["order_id"], [F.col(c) for c in LINE_ORDER],
                                       "order_line_number", sizes=sizes, limit=w.params["hot_order_lines"])
    return n.select("order_id", "line_number", "product_key", "quantity", "order_line_number")


def surrogate_keys(w: Warehouse) -> DataFrame:
    p = w.dim_product.select("product_key", "brand", "product_name")
    return numbering.dense_index(p, [F.col("brand"), F.col("product_name"), F.col("product_key")],
                                 name="surrogate_key")


def surrogate_keys_reload(w: Warehouse) -> DataFrame:
    """Product keys after two loads (`sources/keys.py`): first the products
    sold in the first order year, then all. The second load numbers only the new ones."""
    root = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/product-keys-{uuid.uuid4().hex}"
    keys = KeyMap(w.spark, root, ["product_key"], "surrogate_key")
    products = w.dim_product.select("product_key", "product_name")
    first_year = F.year(w.date_bounds.select("lo").scalar())
    sold = w.sales_lines.where(F.year("order_date") == first_year).select("product_key").distinct()
    keys.assign(products.join(sold, "product_key", "left_semi"), "first load")
    return keys.assign(products, "second load")


def sample_n(w: Warehouse) -> DataFrame:
    s = w.sales_lines.select("order_id", "line_number", "product_key", "l_suppkey", "quantity")
    keys = ["order_id", "line_number", "product_key", "l_suppkey"]
    return sampling.sample_n(s, int(w.params["sample_n"]), w.params["sample_seed"], keys,
                             tie_cols=keys + ["quantity"])


def date_functions(w: Warehouse) -> DataFrame:
    d = w.sales_lines.select("order_date").distinct()
    x = F.col("order_date")
    base = F.lit(fixed.SIGNUP_FALLBACK).cast("date")
    return d.select(
        x.alias("order_date"), cal.date_key(x).alias("date_key"),
        F.dayofmonth(x).alias("day_number"), F.month(x).alias("month_number"),
        F.quarter(x).alias("quarter"), F.year(x).alias("year"),
        cal.sunday_week_number(x).alias("week_number"), cal.is_weekend(x).alias("is_weekend"),
        F.date_format(x, "EEEE").alias("day_name"), F.date_format(x, "MMMM").alias("month_name"),
        F.date_add(x, 7).alias("plus_7_days"), cal.month_start(x).alias("month_start"),
        cal.month_boundaries_between(base, x).alias("months_since_base"),
        F.datediff(x, base).alias("days_since_base"),
        F.date_format(x, "yyyy-MM").alias("year_month"))


def math_null_functions(w: Warehouse) -> DataFrame:
    p = w.dim_product
    price, cost = F.col("selling_price"), F.col("standard_cost")
    margin = money(price - cost)
    return p.select(
        "product_key",
        round_money(price * F.lit(0.16).cast("decimal(2,2)")).alias("vat_16_rounded"),
        F.abs(money(cost - price)).alias("abs_margin"),
        (F.col("product_key") % 7).alias("key_mod_7"),
        F.nullif(F.col("product_key") % 3, F.lit(0)).alias("nullif_mod_3"),
        F.coalesce(F.nullif(F.col("product_key") % 3, F.lit(0)), F.lit(-1)).alias("coalesce_mod_3"),
        (F.col("product_key") % 100).cast("decimal(18,2)").alias("key_as_decimal"),
        ratio(margin, F.col("product_key") % 5, zero=0).alias("divide_or_zero"),
        ratio(margin, F.col("product_key") % 5).alias("divide_or_null"))


def string_functions(w: Warehouse) -> DataFrame:
    c = w.dim_customer
    n = F.col("customer_key") + 1
    return c.select(
        "customer_key",
        F.concat(F.lit(fixed.GENERATED_NAME), n.cast("string")).alias("generated_name"),
        F.date_format("signup_date", "yyyy-MM").alias("signup_month"),
        F.concat(F.lit("Q"), F.quarter("signup_date").cast("string")).alias("signup_quarter"),
        F.upper(F.col("customer_segment")).alias("segment_upper"))
