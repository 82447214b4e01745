"""The star schema, derived from the driver's order tables as lazy DataFrames.

`Warehouse(spark, sf_dir)` reads the raw Parquet tables and exposes the
dimensions and facts of the warehouse. Nothing is computed until an action
runs; Catalyst prunes the columns and joins a query does not use, and
predicates on raw columns (`order_ts`) reach the Parquet scans.

Join strategy (large-cluster view): orders, customers, parts and order lines
grow with the data, so they are joined with shuffles (AQE turns a side into a
broadcast at runtime when its measured size is small). Only tables whose size
is fixed or bounded by the calendar are broadcast by hint: status (5 rows),
market policy (5 rows), nation/region locations (25 rows), campaigns
(6 rows) and the calendar (366 rows per year of order dates).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions import fixed
from duka.functions.money import MONEY, RATE, money, round_money
from duka.sources.literals import literal_table
from duka.functions.localize import line_measures


# A total order over every input column of an order line: lines equal on all
# of them are identical, so any numbering among them gives equal output.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


class Warehouse:
    """Dimensions and facts of the retail warehouse over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, **params):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.params = {**fixed.DEFAULTS, **params}

    # ------------------------------------------------------------------ raw
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ----------------------------------------------------------- fixed dims
    @cached_property
    def dim_status(self) -> DataFrame:
        return literal_table(self.spark, fixed.STATUSES,
                             [("status_key", "int"), ("status_name", "string")])

    @cached_property
    def market_policy(self) -> DataFrame:
        """Currency, price factor, VAT and FX rate per country (region)."""
        return literal_table(self.spark, fixed.market_rows(), [
            ("country", "string"), ("local_currency", "string"),
            ("price_factor", "decimal(8,2)"), ("vat_rate", "decimal(4,2)"),
            ("fx_rate", "decimal(18,5)")])

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return literal_table(self.spark, fixed.campaign_rows(), [
            ("campaign_key", "int"), ("campaign_name", "string"), ("channel", "string"),
            ("campaign_cost", "decimal(18,2)"), ("start_date", "date"), ("end_date", "date")])

    # ------------------------------------------------------------ calendar
    @cached_property
    def date_bounds(self) -> DataFrame:
        """First and last calendar day of the years holding order dates.

        A global min/max: partial aggregates per task, one row at the end.
        """
        o = self.table("orders")
        return o.agg(
            F.trunc(F.min("o_orderdate").cast("date"), "YEAR").alias("lo"),
            F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("hi"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        days = self.date_bounds.select(
            F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
        return days.select(*[c.alias(n) for n, c in cal.calendar_columns("full_date").items()])

    # ---------------------------------------------------------- location
    @cached_property
    def dim_location(self) -> DataFrame:
        n = self.table("nation")
        r = self.table("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                .select(n.n_nationkey.alias("location_key"), n.n_name.alias("city"),
                        n.n_name.alias("region"), r.r_name.alias("country")))

    @cached_property
    def location_market(self) -> DataFrame:
        """location_key -> country + market policy; NULL policy values where
        the country has none, so its lines stay."""
        return self.dim_location.join(F.broadcast(self.market_policy), "country", "left")

    # ------------------------------------------------------------ product
    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.table("part")
        price = F.col("p_retailprice").cast(MONEY)
        band = None
        for upper, label in fixed.SIZE_BANDS[:-1]:
            band = (F.when(F.col("p_size") <= upper, label) if band is None
                    else band.when(F.col("p_size") <= upper, label))
        band = band.otherwise(fixed.SIZE_BANDS[-1][1])
        return p.select(
            F.col("p_partkey").alias("product_key"),
            (F.col("p_partkey") + 101).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            band.alias("sub_category"),
            round_money(price * F.lit(0.5).cast("decimal(2,1)")).alias("standard_cost"),
            price.alias("selling_price"),
        )

    # ----------------------------------------------------------- customer
    @staticmethod
    def customer_rule_columns(custkey: Column) -> dict[str, Column]:
        """Attributes derived from the 1-based customer number (B17 rules)."""
        n = custkey + 1
        seg = None
        for k, label in fixed.SEGMENT_RULES:
            cond = (n % k) == 0
            seg = F.when(cond, label) if seg is None else seg.when(cond, label)
        seg = seg.otherwise(fixed.SEGMENT_DEFAULT)
        age = F.element_at(F.array(*[F.lit(a) for a in fixed.AGE_GROUPS]), (n % 4 + 1).cast("int"))
        return {
            "customer_id": (n + fixed.CUSTOMER_ID_BASE).cast("long"),
            "gender": F.when(n % 2 == 0, fixed.GENDER_EVEN).otherwise(fixed.GENDER_ODD),
            "age_group": age,
            "customer_segment": seg,
        }

    @cached_property
    def customer_first_order(self) -> DataFrame:
        o = self.table("orders")
        return o.groupBy(F.col("o_custkey").alias("customer_key")).agg(
            F.min("o_orderdate").cast("date").alias("first_order_date"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        """One current row per customer; signup = first order date."""
        c = self.table("customer")
        rules = self.customer_rule_columns(F.col("c_custkey"))
        base = c.select(
            F.col("c_custkey").alias("customer_key"),
            rules["customer_id"].alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            rules["gender"].alias("gender"),
            rules["age_group"].alias("age_group"),
            F.col("c_nationkey").alias("location_key"),
            rules["customer_segment"].alias("customer_segment"),
        )
        signup = F.coalesce(F.col("first_order_date"), F.lit(fixed.SIGNUP_FALLBACK).cast("date"))
        return (base.join(self.customer_first_order, "customer_key", "left")
                .select("customer_key", "customer_id", "customer_name", "gender", "age_group",
                        "location_key", signup.alias("signup_date"), "customer_segment",
                        signup.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
                        F.lit(True).alias("is_current")))

    @cached_property
    def customer_keys(self) -> DataFrame:
        """Customer dimension without the signup lookup (no orders scan)."""
        c = self.table("customer")
        rules = self.customer_rule_columns(F.col("c_custkey"))
        return c.select(F.col("c_custkey").alias("customer_key"),
                        *[v.alias(k) for k, v in rules.items()],
                        F.col("c_name").alias("customer_name"),
                        F.col("c_nationkey").alias("location_key"))

    # ---------------------------------------------------- customer versions
    @cached_property
    def customer_observations(self) -> DataFrame:
        """(customer, 1 Jan of year, tier by that year's order count)."""
        per_year = (self.table("orders").groupBy(F.col("o_custkey").alias("customer_key"),
                                                 F.year("o_orderdate").alias("y"))
                    .agg(F.count(F.lit(1)).alias("orders")))
        tier = None
        for k, label in fixed.TIER_BY_ORDERS:
            cond = F.col("orders") >= k
            tier = F.when(cond, label) if tier is None else tier.when(cond, label)
        tier = tier.otherwise(fixed.TIER_DEFAULT)
        return per_year.select("customer_key", F.make_date("y", F.lit(1), F.lit(1)).alias("obs_date"),
                               tier.alias("customer_segment"))

    @cached_property
    def customer_versions(self) -> DataFrame:
        """The customer dimension's versions (SCD type 2) with their keys."""
        from duka.operators import scd2
        return self.with_version_keys(scd2.build_versions(
            self.customer_observations, "customer_key", "obs_date", "customer_segment"))

    @staticmethod
    def with_version_keys(versions: DataFrame) -> DataFrame:
        from duka.operators import scd2
        return versions.select("customer_key", (F.col("customer_key") + 1 + fixed.CUSTOMER_ID_BASE).cast("long")
                        .alias("customer_id"), scd2.version_key("customer_key", "valid_from")
                        .alias("customer_version_key"), "version", "customer_segment", "valid_from",
                        "valid_to", "is_current")

    def current_lines(self, customer_key: int) -> DataFrame:
        """A customer's sales lines that belong to the current version."""
        current = self.customer_versions.where((F.col("customer_key") == customer_key) & F.col("is_current")) \
            .select("customer_key", "valid_from")
        lines = self.sales_lines.where(F.col("customer_key") == customer_key)
        return lines.join(current, "customer_key").where(F.col("order_date") >= F.col("valid_from"))

    # --------------------------------------------------------------- sales
    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines joined to their order, customer market and part price.

        orders are joined to customers first (orders are a quarter of the
        lines), so the line-sized input is shuffled only for the part and
        the order joins: for the part while it is as narrow as the raw lines,
        then for the order, by which it stays dealt. A line whose customer, location, market policy or
        part is unknown stays, with NULL in what that row would give; a line
        without an order has no date and is left to `dq_orphans`.
        """
        return self.lines_of(self.raw_orders)

    @property
    def raw_orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")

    def lines_of(self, o: DataFrame, numbered: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """`order_lines` of the given orders; their further columns stay.
        `numbered` is applied to the lines joined to their orders, while they
        are dealt by order."""
        c = self.table("customer").select("c_custkey", "c_nationkey")
        orders = o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")
        li, part = self.table("lineitem"), self.table("part").select("p_partkey", "p_retailprice")
        priced = li.join(part, li.l_partkey == part.p_partkey, "left").drop("p_partkey")
        # the market columns of 25 locations need no shuffle of the orders that carries them
        lines = (priced.join(orders, priced.l_orderkey == orders.o_orderkey).drop("o_orderkey")
                 .join(F.broadcast(self.location_market), F.col("c_nationkey") == F.col("location_key"), "left")
                 .drop("c_nationkey", "city", "region"))
        return numbered(lines) if numbered else lines

    @staticmethod
    def status_rule() -> Column:
        rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
        return (F.when((rf == "R") & (ls == "O"), 5)
                .when(rf == "R", 2)
                .when((rf == "N") & (F.col("o_orderpriority") == "5-LOW"), 3)
                .when((F.col("o_orderstatus") == "P") & (ls == "O"), 4)
                .otherwise(1).cast("int"))

    @cached_property
    def sales_lines(self) -> DataFrame:
        """Fact sales at order-line grain, localised and with USD measures.

        Surrogate and line-number keys are added only by `fact_sales`, so
        queries that do not need them never pay for the numbering.
        """
        return self.derive_sales(self.order_lines)

    def derive_sales(self, x: DataFrame, *carry: str) -> DataFrame:
        """Sales-line columns from joined order lines (`order_lines`), keeping
        the `carry` columns (e.g. keys assigned before the derivation)."""
        n_campaigns = len(fixed.CAMPAIGNS)
        sources = F.array(*[F.lit(s) for s in fixed.ORDER_SOURCES])
        price = F.col("p_retailprice").cast(MONEY)
        cost = round_money(price * F.lit(0.5).cast("decimal(2,1)"))
        base = x.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_key"),
            F.col("o_custkey").alias("customer_key"),
            F.col("location_key"),
            F.col("country"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            cal.date_key(F.col("o_orderdate").cast("date")).alias("date_key"),
            (F.pmod(F.col("l_orderkey"), F.lit(n_campaigns)) + 1).cast("int").alias("campaign_key"),
            self.status_rule().alias("status_key"),
            F.element_at(sources, (F.pmod(F.col("l_orderkey"), F.lit(3)) + 1).cast("int"))
            .alias("order_source"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("local_currency"),
            F.col("fx_rate").cast(RATE).alias("exchange_rate_to_usd"),
            F.col("vat_rate"),
            money(price * F.col("price_factor")).alias("unit_price_local"),
            money(cost * F.col("price_factor")).alias("product_cost_local"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
            # raw line columns, kept for total orders over lines (pruned
            # by Catalyst when a query does not use them)
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
            *carry,
        )
        return line_measures(base)

    @cached_property
    def fact_sales_keyed(self) -> DataFrame:
        """Sales lines with their keys: sales_fact_key is dense 1..n over
        (order, line columns) and order_line_number numbers the lines of an
        order.

        Orders are numbered, not lines: an order's first key is the running
        total of the line counts before it (order-grain rows only), and the
        customer version valid on the order's day is found there too. The
        lines are numbered inside their order where the join to the orders
        has dealt them already, so no line is shuffled for its keys. Orders
        of more than `hot_order_lines` lines, if there are any, are numbered
        by the distributed operator instead, so none is one task's work.
        """
        from duka.operators import asof, numbering
        versioned = asof.asof_merge(self.raw_orders, "o_custkey", "o_orderdate", self.customer_versions,
                                    "customer_key", "valid_from", ["customer_version_key"])
        counts = self.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
        orders = versioned.join(counts, versioned.o_orderkey == counts.l_orderkey).drop("l_orderkey")
        orders = numbering.running_totals(orders, [F.col("o_orderkey")], "_lines", "_first")
        limit = self.params["hot_order_lines"]
        hot = not orders.where(F.col("_lines") > limit).isEmpty()
        by_line = [F.col(c) for c in LINE_ORDER]

        def numbered(lines: DataFrame) -> DataFrame:
            number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*by_line))
            small = lines.where(F.col("_lines") <= limit).withColumn("order_line_number", number)
            if not hot:
                return small
            return small.unionByName(numbering.number_over_ranges(
                lines.where(F.col("_lines") > limit), ["l_orderkey"], by_line, "order_line_number"))

        lines = self.lines_of(orders, numbered).withColumn(
            "sales_fact_key", (F.col("_first") + F.col("order_line_number")).cast("bigint"))
        return self.derive_sales(lines, "sales_fact_key", "order_line_number", "customer_version_key")

    def sales_from(self, start_date: str) -> DataFrame:
        """Sales lines on or after a date; the bound reaches the orders scan."""
        ts = F.lit(start_date).cast("timestamp_ntz")
        return self.sales_lines.where(F.col("order_ts") >= ts)

    def sales_in_year(self, year: int) -> DataFrame:
        lo = F.lit(f"{year:04d}-01-01").cast("timestamp_ntz")
        hi = F.lit(f"{year + 1:04d}-01-01").cast("timestamp_ntz")
        return self.sales_lines.where((F.col("order_ts") >= lo) & (F.col("order_ts") < hi))

    def sales_between(self, first, last) -> DataFrame:
        """Sales lines from one day to another, both included."""
        lo, hi = F.lit(first).cast("timestamp_ntz"), F.date_add(F.lit(last), 1).cast("timestamp_ntz")
        return self.sales_lines.where((F.col("order_ts") >= lo) & (F.col("order_ts") < hi))

    # ----------------------------------------------------------- inventory
    @cached_property
    def inventory_span(self) -> tuple:
        """First and last day of the stock snapshot: the last calendar years
        with orders (`inventory_last_years`), as two dates."""
        r = self.date_bounds.select(F.make_date(F.year("hi") - (self.params["inventory_last_years"] - 1),
                                                F.lit(1), F.lit(1)).alias("lo"), "hi").first()
        return r.lo, r.hi

    def stock_runs(self, products: DataFrame | None = None, sales: DataFrame | None = None) -> DataFrame:
        """(product_key, first_day, last_day, sold): the snapshot's days as
        runs. A day with sales is a run of its own, idle days between two of
        them are one run (sold NULL). Rows grow with the sales, not with
        products x days. `products` restricts the lines before they are
        summed (e.g. one category). `sales`: the sales lines, where they are
        written already."""
        from duka.operators.ranges import value_runs
        lo, hi = self.inventory_span
        lines = self.sales_between(lo, hi) if sales is None else sales.where(F.col("order_date").between(lo, hi))
        if products is not None:
            lines = lines.join(products.select("product_key"), "product_key", "left_semi")
        sold = lines.groupBy("product_key", "order_date").agg(F.sum("quantity").alias("sold"))
        everything = self.dim_product if products is None else products
        return value_runs(everything.select("product_key"), "product_key", sold, "order_date", "sold", lo, hi)

    def stock_totals(self, products: DataFrame | None = None) -> DataFrame:
        """Per product: days, and the sums over days of opening, sold and
        closing stock, from the runs by their lengths."""
        days = F.datediff("last_day", "first_day") + 1
        # deliveries come on the first of a month
        firsts = cal.month_boundaries_between(F.date_sub("first_day", 1), F.col("last_day"))
        sold = F.coalesce(F.col("sold"), F.lit(0))
        opened = F.lit(fixed.OPENING_STOCK).cast("bigint") * days
        return self.stock_runs(products).groupBy("product_key").agg(
            F.sum(days.cast("bigint")).alias("days"), F.sum(opened).alias("opening_stock"), F.sum(sold).alias("stock_sold"),
            F.sum(opened + firsts * fixed.RESTOCK_UNITS - sold).alias("closing_stock"))

    def month_end_stock(self) -> DataFrame:
        """(product_key, date_key, closing_stock) on the last day of each month."""
        from duka.operators.ranges import run_months
        end = F.last_day("month")
        return run_months(self.stock_runs(), "month").where(end <= F.col("last_day")).select(
            "product_key", cal.date_key(end).alias("date_key"),
            (F.lit(fixed.OPENING_STOCK) - F.coalesce("sold", F.lit(0))).alias("closing_stock"))

    def fact_inventory(self, products: DataFrame | None = None) -> DataFrame:
        """Daily stock snapshot per product: the runs, day by day. The days
        are generated where they are consumed; the grid is never shuffled."""
        from duka.operators.ranges import explode_days
        grid = explode_days(self.stock_runs(products), "first_day", "last_day")
        day = F.dayofmonth("full_date")
        received = F.when(day == 1, fixed.RESTOCK_UNITS).otherwise(0)
        stock_sold = F.coalesce(F.col("sold"), F.lit(0))
        return grid.select(
            cal.date_key("full_date").alias("date_key"), "product_key",
            F.lit(fixed.OPENING_STOCK).cast("int").alias("opening_stock"),
            received.cast("int").alias("stock_received"),
            stock_sold.cast("int").alias("stock_sold"),
            F.when(day % fixed.RETURN_DAY_MODULUS == 0, fixed.RETURNED_UNITS)
            .otherwise(0).cast("int").alias("stock_returned"),
            (F.lit(fixed.OPENING_STOCK) + received - stock_sold).cast("int").alias("closing_stock"))

    # ----------------------------------------------------------- marketing
    @cached_property
    def campaign_days(self) -> DataFrame:
        """Campaign cost spread over the calendar days of each campaign.

        The range condition `full_date BETWEEN start AND end` becomes
        `explode(sequence(start, end))` plus an equi-join to the calendar.
        Cost per day divides by the day difference (end - start), as the
        source does; a one-day campaign gets NULL instead of a zero division.
        """
        c = self.dim_campaign
        days = c.select(
            "campaign_key", "campaign_cost", "start_date", "end_date",
            F.explode(F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY")))
            .alias("full_date"))
        days = days.join(F.broadcast(self.dim_date.select("full_date", "date_key")), "full_date")
        span = F.datediff("end_date", "start_date")
        cost = F.round(F.col("campaign_cost") / F.nullif(span, F.lit(0)).cast("decimal(10,0)"), 2)
        return days.select("date_key", "campaign_key", cost.cast(MONEY).alias("cost"))

    @staticmethod
    def funnel_counts(events: DataFrame) -> DataFrame:
        """Funnel counts per (day, campaign) from events, batch or stream.

        Events are shifted onto the order calendar and assigned to a
        campaign by user id; partial aggregation happens before the shuffle,
        so the shuffled size is bounded by days x campaigns.
        """
        n_campaigns = len(fixed.CAMPAIGNS)
        day = F.add_months(F.col("ts").cast("date"), fixed.EVENT_SHIFT_MONTHS)
        et = F.col("event_type")
        return (events.select(cal.date_key(day).alias("date_key"),
                              (F.pmod(F.col("user_id"), F.lit(n_campaigns)) + 1).cast("int")
                              .alias("campaign_key"),
                              et, F.col("value").cast(MONEY).alias("value"))
                .groupBy("date_key", "campaign_key")
                .agg(F.count_if(et == "view").alias("impressions"),
                     F.count_if(et == "click").alias("clicks"),
                     F.count_if(et == "purchase").alias("conversions"),
                     F.sum(F.when(et == "purchase", F.col("value"))).alias("revenue")))

    @cached_property
    def campaign_events(self) -> DataFrame:
        return self.funnel_counts(self.table("events"))

    def marketing_from_counts(self, counts: DataFrame) -> DataFrame:
        """The campaign-day fact: cost rows with the day's funnel counts."""
        zero = F.lit(0).cast("bigint")
        return (self.campaign_days.join(counts, ["date_key", "campaign_key"], "left")
                .select("date_key", "campaign_key",
                        F.coalesce("impressions", zero).alias("impressions"),
                        F.coalesce("clicks", zero).alias("clicks"),
                        F.coalesce("conversions", zero).alias("conversions"),
                        F.coalesce(F.col("revenue"), F.lit(0)).cast(MONEY).alias("revenue_generated"),
                        "cost"))

    @cached_property
    def fact_marketing(self) -> DataFrame:
        return self.marketing_from_counts(self.campaign_events)
