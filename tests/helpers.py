"""Small warehouses built from hand-written rows (FIXTURES.md section 3)."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.sources.literals import literal_table
from duka.sources.warehouse import Warehouse

D = Decimal


class FixtureWarehouse(Warehouse):
    """A Warehouse whose facts are given rows; the calendar spans the
    given years and the fixed dimensions are the real ones."""

    def __init__(self, spark, sales=None, inventory=None, marketing=None, products=None,
                 customers=None, first_year=2023, last_year=2025, **params):
        super().__init__(spark, "/nonexistent", **params)
        self._sales, self._inv, self._mkt = sales, inventory, marketing
        self._products, self._customers = products, customers
        self._years = (first_year, last_year)

    @cached_property
    def date_bounds(self):
        lo, hi = self._years
        return self.spark.range(1).select(F.lit(f"{lo}-01-01").cast("date").alias("lo"),
                                          F.lit(f"{hi}-12-31").cast("date").alias("hi"))

    @cached_property
    def sales_lines(self):
        return self._sales

    @cached_property
    def fact_marketing(self):
        return self._mkt

    @cached_property
    def dim_product(self):
        return self._products

    @cached_property
    def customer_keys(self):
        return self._customers

    def fact_inventory(self, products=None):
        return self._inv

    def stock_totals(self, products=None):
        return self._inv.groupBy("product_key").agg(
            F.count(F.lit(1)).alias("days"), *[F.sum(c).alias(c) for c in ("opening_stock", "stock_sold", "closing_stock")])

    def month_end_stock(self):
        return self._inv


SALES_SCHEMA = [("order_id", "bigint"), ("customer_key", "bigint"), ("product_key", "bigint"),
                ("order_date", "date"), ("status_key", "int"), ("quantity", "int"),
                ("net_revenue_usd", "decimal(18,2)"), ("campaign_key", "int")]


def sales(spark, rows):
    """rows: (order_id, customer, product, 'yyyy-mm-dd', status, qty, net, campaign)."""
    df = literal_table(spark, rows, SALES_SCHEMA)
    return df.withColumn("date_key", cal.date_key("order_date")) \
        .withColumn("order_ts", F.col("order_date").cast("timestamp_ntz"))


def products(spark, rows):
    """rows: (product_key, product_name, category, standard_cost)."""
    df = literal_table(spark, rows, [("product_key", "bigint"), ("product_name", "string"),
                                     ("category", "string"), ("standard_cost", "decimal(18,2)")])
    return df.withColumns({"product_id": F.col("product_key") + 101, "brand": F.lit("B"),
                           "sub_category": F.lit("S"), "selling_price": F.col("standard_cost") * 2})
