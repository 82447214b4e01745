"""Dashboard measures, evaluated on a fixed slice each.

A measure has no grain of its own; each function picks the slice named in
its docstring. Windows run over aggregated rows (months, dates per slice),
never over fact-grain rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import TOTAL, ratio, total
from duka.sources.warehouse import Warehouse


def fiscal_ytd_sales(w: Warehouse) -> DataFrame:
    """Per fiscal month: net revenue and its running total since 1 July."""
    m = (w.sales_lines.groupBy(cal.fiscal_year("order_date").alias("fiscal_year"),
                               cal.fiscal_month("order_date").alias("fiscal_month"))
         .agg(total("net_revenue_usd").alias("sales_usd")))
    ytd = Window.partitionBy("fiscal_year").orderBy("fiscal_month") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return m.withColumn("fiscal_ytd_sales_usd", F.sum("sales_usd").over(ytd).cast(TOTAL))


def ending_inventory(w: Warehouse) -> DataFrame:
    """Per year, month, category: closing stock on the last day with rows.
    Stock is semi-additive: summed over products on a day, never over days."""
    inv = w.month_end_stock().join(w.dim_product.select("product_key", "category"), "product_key")
    daily = (inv.groupBy(cal.year_of_key("date_key").alias("year"),
                         cal.month_of_key("date_key").alias("month_number"), "category", "date_key")
             .agg(F.sum("closing_stock").alias("stock")))
    return (daily.groupBy("year", "month_number", "category")
            .agg(F.max_by("stock", "date_key").alias("ending_stock")))


def inventory_turnover_ratio(w: Warehouse) -> DataFrame:
    """Per category: COGS from sales / average stock value, 0 if undefined."""
    products = w.dim_product.select("product_key", "category", "standard_cost")
    cogs = (w.sales_lines.groupBy("product_key").agg(F.sum("cost_usd").alias("c"))
            .join(products, "product_key").groupBy("category")
            .agg(total("c").alias("total_cogs_usd")))
    stock = (w.stock_totals().select("product_key", F.col("closing_stock").alias("cl"), F.col("days").alias("n"))
             .join(products, "product_key").groupBy("category")
             .agg(F.sum(F.col("cl") * F.col("standard_cost")).alias("_value"),
                  F.sum("n").alias("_n")))
    cats = w.dim_product.select("category").distinct()
    j = cats.join(cogs, "category", "left").join(stock, "category", "left")
    # AVERAGE(value) = sum / n; DIVIDE(cogs, avg, 0) = cogs * n / sum
    return j.select("category", "total_cogs_usd",
                    ratio("_value", "_n").alias("avg_inventory_value_usd"),
                    ratio(F.col("total_cogs_usd") * F.col("_n"), "_value", zero=0)
                    .alias("inventory_turnover_ratio"))


def net_revenue_ex_tax(w: Warehouse) -> DataFrame:
    """Per country: sum(gross / (1 + VAT of the country)). Lines are summed
    per VAT rate and divided once, so each output rounds once."""
    rates = w.location_market.select("location_key", "vat_rate")
    by_rate = (w.sales_lines.select("location_key", "country", "gross_revenue_usd")
               .join(rates, "location_key", "left")    # unknown locations keep their group
               .groupBy("country", "vat_rate")
               .agg(total("gross_revenue_usd").alias("g")))
    ex = ratio("g", F.lit(1) + F.col("vat_rate"))
    return (by_rate.withColumn("x", ex).groupBy("country")
            .agg(total("g").alias("gross_revenue_usd"), total("x").alias("net_revenue_ex_tax_usd")))


def returns_liability(w: Warehouse) -> DataFrame:
    """Per year and quarter: returned revenue / completed revenue (0 if no
    completed revenue)."""
    st = F.col("status_key")
    net = F.col("net_revenue_usd")
    q = (w.sales_lines.groupBy(F.year("order_date").alias("year"),
                               F.quarter("order_date").alias("quarter"))
         .agg(total(F.when(st == fixed.status_key("Returned"), net)).alias("returned_usd"),
              total(F.when(st == fixed.status_key("Completed"), net)).alias("settled_usd")))
    risk = F.when(F.col("returned_usd").isNull(), F.lit(None)).otherwise(
        ratio("returned_usd", "settled_usd", scale=4, zero=0))
    return q.withColumn("active_revenue_risk", risk.cast("decimal(38,4)"))


def rolling_12m_ltv(w: Warehouse) -> DataFrame:
    """Per month: revenue of the trailing 12 months / distinct customers of
    the month itself (the division sits outside the 12-month filter)."""
    per_customer = (w.sales_lines.groupBy(F.year("order_date").alias("year"),
                                          F.month("order_date").alias("month_number"),
                                          "customer_key")
                    .agg(F.sum("net_revenue_usd").alias("n")))
    m = (per_customer.groupBy("year", "month_number")
         .agg(F.sum("n").alias("rev"), F.count(F.lit(1)).alias("active_customers"))
         .withColumn("mi", cal.month_index(F.col("year"), F.col("month_number"))))
    trailing = Window.orderBy("mi").rangeBetween(-11, 0)
    t = m.withColumn("trailing_12m_revenue_usd", F.sum("rev").over(trailing).cast(TOTAL))
    return t.select("year", "month_number", "trailing_12m_revenue_usd", "active_customers",
                    ratio("trailing_12m_revenue_usd", "active_customers").alias("rolling_12m_ltv_usd"))
