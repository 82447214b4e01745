"""The built warehouse serves every query with the same answers."""

import pytest

import __spark_entry__ as E
from duka.oracle.compare import _rows, duck
from duka.plans import registry
from duka.sources.store import build_warehouse
from duka.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL

# the query that builds a star of its own is tested over the raw tables
NAMES = sorted(set(registry.PLANS) - {"star_row_counts"})


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    times = build_warehouse(Warehouse(spark, SF_SMALL), out)
    assert "fact_sales" in times and "inventory_runs" in times
    return out


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_stored_query_matches_oracle(spark, store, con, name):
    df = registry.run(name, spark, SF_SMALL, store_dir=store)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, rows) == _rows(cols, res.fetchall())


def test_year_filter_prunes_stored_folders(spark, store):
    df = registry.run("monthly_revenue", spark, SF_SMALL, store_dir=store)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan and "(order_year#" in plan
    assert "= 2000)" in plan


def test_stored_fact_reads_only_needed_columns(spark, store):
    df = registry.run("customer_metrics", spark, SF_SMALL, store_dir=store)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "fact_sales" in line and "ReadSchema" in line][0]
    assert "ReadSchema: struct<customer_key:bigint,status_key:int,quantity:int," \
           "net_revenue_usd:decimal(18,2)>" in scan


def test_sales_columns_that_follow_from_others_are_not_stored(spark, store):
    raw, star = Warehouse(spark, SF_SMALL), registry.warehouse(spark, SF_SMALL, store)
    derived = {"l_partkey", "l_linenumber", "line_amount_local", "line_cost_local", "cost_usd"}
    stored = set(spark.read.parquet(star.folders["fact_sales"]).columns)
    full = raw.fact_sales_keyed
    assert stored == set(full.columns) - derived | {"order_year"}
    for column in ("sales_lines", "fact_sales_keyed"):
        assert set(getattr(star, column).columns) == set(full.columns) | {"order_year"}
    back = star.fact_sales_keyed.select(full.columns)
    assert back.schema.simpleString() == full.schema.simpleString()
    assert full.exceptAll(back).isEmpty() and back.exceptAll(full).isEmpty()


def test_lines_are_dealt_by_part_before_they_carry_order_columns(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Warehouse(spark, SF_SMALL).sales_lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    depth = {key: min(line.index("Exchange") for line in plan.splitlines() if f"Exchange hashpartitioning({key}#" in line)
             for key in ("l_partkey", "l_orderkey")}
    assert depth["l_partkey"] > depth["l_orderkey"]


def test_inventory_is_summed_from_the_written_sales(spark, store, tmp_path, monkeypatch):
    w = Warehouse(spark, SF_SMALL)
    monkeypatch.setattr(Warehouse, "sales_between", None)       # joins lines to their orders
    monkeypatch.setattr(Warehouse, "fact_inventory", lambda self: self.table("part"))
    monkeypatch.setattr("duka.sources.schemas.check", lambda df, name: df)
    build_warehouse(w, str(tmp_path))
    monkeypatch.undo()
    got = registry.warehouse(spark, SF_SMALL, str(tmp_path)).stock_runs()
    want = w.stock_runs()
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
