"""Materialised warehouse: build the star once, let reports read it.

`build_warehouse(w, out_dir)` writes every dimension and fact as Parquet
(full reload, the INSERT ... SELECT after TRUNCATE of the load scripts) into new
folders and publishes them all at once (`publish.py`): a build that dies half-way leaves
readers the tables they had. `StoredWarehouse(spark, out_dir, sf_dir)` then serves the
same attributes as `Warehouse` from those files, so every report runs
unchanged but scans one pre-joined fact instead of re-joining order lines,
orders, customers and parts.

Layout for large data: the sales fact is written straight from the keying
job (no extra shuffle of the whole fact for layout), partitioned by order
year and sorted by day inside each file, so a year filter prunes folders
and a day range skips row groups by their statistics; the inventory
snapshot is stored as runs of days (a day with sales, or the idle days up to
the next one). Columns of a sales line that repeat or follow from others of it
(`sales_columns`) are not stored, readers derive them. Small dimensions are
written as single files.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duka.functions.localize import cost_usd, line_amounts
from duka.plans.builds import fact_sales_full
from duka.sources import schemas
from duka.sources.publish import Published
from duka.sources.warehouse import Warehouse

SMALL_TABLES = ["dim_status", "dim_campaign", "dim_location", "location_market", "dim_date",
                "campaign_days", "fact_marketing"]
LARGE_TABLES = ["dim_product", "dim_customer", "customer_versions"]
REPEATED = {"l_partkey": "product_key", "l_linenumber": "line_number"}


def sales_columns(stored: DataFrame) -> DataFrame:
    """The stored sales fact with the columns that are derived when it is read."""
    repeated = {name: F.col(of) for name, of in REPEATED.items()}
    return stored.withColumns(repeated | line_amounts()).withColumn("cost_usd", cost_usd())


def _write(df: DataFrame, path: str, partition_by: list[str] | None = None, look_up: str | None = None) -> None:
    """`look_up`: a column that gets bloom filters, so that a reader of one of
    its values skips the row groups without it."""
    writer = df.write.option("compression", "zstd")
    if look_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{look_up}", "true") \
            .option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def build_warehouse(w: Warehouse, out_dir: str, parallel_jobs: int = 4) -> dict[str, float]:
    """Write all warehouse tables under out_dir and publish them together;
    returns seconds per table.

    The write jobs are submitted from a few driver threads at once and share
    the cluster; no row passes through the driver. Only the inventory waits,
    for the sales that it sums.
    """
    published = Published(w.spark, out_dir)
    folders: dict[str, str] = {}

    def place(name: str) -> str:
        folders[name] = published.new_folder(name)
        return published.path(folders[name])

    lines_written = Event()

    def sales() -> None:
        try:
            write_sales()
        finally:
            lines_written.set()

    def write_sales() -> None:
        df = schemas.check(fact_sales_full(w), "fact_sales") \
            .withColumn("order_year", F.year("order_date"))
        # no extra shuffle for the layout: each task of the keying job writes
        # its rows into the order-year folders, sorted by day, so a year
        # filter prunes folders and Parquet row-group statistics skip day
        # ranges inside the files (at most tasks x years files)
        laid_out = df.drop(*REPEATED, *line_amounts(), "cost_usd").sortWithinPartitions("order_year", "date_key")
        _write(laid_out, place("fact_sales"), ["order_year"], look_up="customer_key")

    def inventory() -> None:
        # kept as runs of days: rows grow with the sales; readers generate days
        schemas.check(w.fact_inventory(), "fact_inventory")
        # from the fact just written, so order lines are not joined to their orders again
        lines_written.wait()
        lines = w.spark.read.parquet(published.path(folders["fact_sales"]))
        _write(w.stock_runs(sales=lines), place("inventory_runs"))

    def table(name: str) -> DataFrame:
        df = getattr(w, name)
        return schemas.check(df, name) if name in schemas.TABLES else df

    jobs = {"fact_sales": sales, "inventory_runs": inventory}
    for name in SMALL_TABLES:
        jobs[name] = lambda n=name: _write(table(n).repartition(1), place(n))
    for name in LARGE_TABLES:
        jobs[name] = lambda n=name: _write(table(n), place(n))

    def timed(item):
        name, fn = item
        t0 = time.perf_counter()
        fn()
        return name, round(time.perf_counter() - t0, 3)

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        times = dict(pool.map(timed, jobs.items()))
    published.publish(folders, f"build-{uuid.uuid4().hex}")
    return times


class StoredWarehouse(Warehouse):
    """A Warehouse whose tables come from `build_warehouse` output.

    Raw driver tables (orders for SCD2 history, data-quality checks) are
    still read from `sf_dir`.
    """

    def __init__(self, spark: SparkSession, store_dir: str, sf_dir: str, **params):
        super().__init__(spark, sf_dir, **params)
        self.store_dir = store_dir.rstrip("/")
        # resolved once: a load published later does not change this reader
        self.folders = Published(spark, store_dir).folders()

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.folders[name])

    dim_status = cached_property(lambda self: self.stored("dim_status"))
    dim_campaign = cached_property(lambda self: self.stored("dim_campaign"))
    dim_location = cached_property(lambda self: self.stored("dim_location"))
    location_market = cached_property(lambda self: self.stored("location_market"))
    dim_date = cached_property(lambda self: self.stored("dim_date"))
    campaign_days = cached_property(lambda self: self.stored("campaign_days"))
    fact_marketing = cached_property(lambda self: self.stored("fact_marketing"))
    dim_product = cached_property(lambda self: self.stored("dim_product"))
    dim_customer = cached_property(lambda self: self.stored("dim_customer"))

    customer_versions = cached_property(lambda self: self.stored("customer_versions"))

    def current_lines(self, customer_key: int) -> DataFrame:
        current = self.customer_versions.where((F.col("customer_key") == customer_key) & F.col("is_current")) \
            .select("customer_version_key")
        lines = self.sales_lines.where(F.col("customer_key") == customer_key)
        return lines.join(current, "customer_version_key", "left_semi")

    @cached_property
    def customer_keys(self) -> DataFrame:
        return self.dim_customer.select("customer_key", "customer_id", "gender", "age_group",
                                        "customer_segment", "customer_name", "location_key")

    @cached_property
    def sales_lines(self) -> DataFrame:
        return sales_columns(self.stored("fact_sales"))

    @cached_property
    def fact_sales_keyed(self) -> DataFrame:
        return self.sales_lines

    def sales_from(self, start_date: str) -> DataFrame:
        year = int(start_date[:4])
        return super().sales_from(start_date).where(F.col("order_year") >= year)

    def sales_in_year(self, year: int) -> DataFrame:
        return super().sales_in_year(year).where(F.col("order_year") == year)

    @cached_property
    def date_bounds(self) -> DataFrame:
        return self.dim_date.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))

    def sales_between(self, first, last) -> DataFrame:
        return super().sales_between(first, last).where(F.col("order_year").between(first.year, last.year))

    def stock_runs(self, products: DataFrame | None = None) -> DataFrame:
        runs = self.stored("inventory_runs")
        return runs if products is None else runs.join(products.select("product_key"), "product_key", "left_semi")
