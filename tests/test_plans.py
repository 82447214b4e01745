"""Plan shape checks: what the physical plans must (not) contain."""

import pytest

from duka.plans import registry
from tests.conftest import SF_SMALL

NAMES = sorted(registry.PLANS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(registry.run(name, spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_not_in_has_no_null_aware_broadcast(spark):
    plan = _plan(registry.run("dead_stock", spark, SF_SMALL))
    assert "isNullAwareAntiJoin=true" not in plan.replace(" ", "")
    plan = _plan(registry.run("anti_join_not_in", spark, SF_SMALL))
    assert "LeftAnti" in plan


def test_order_date_bound_reaches_the_scan(spark):
    df = registry.run("monthly_revenue", spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_customer_key_reaches_the_scan(spark):
    plan = _plan(registry.run("customer_lifetime_value", spark, SF_SMALL))
    assert "EqualTo(o_custkey,4)" in plan


def test_growth_window_runs_on_aggregated_rows(spark):
    # the unpartitioned window sits above the aggregation, never on lines
    plan = _plan(registry.run("mom_growth", spark, SF_SMALL))
    window_at = plan.index("Window")
    assert plan.index("HashAggregate") > window_at


def test_numbering_has_no_global_window(spark):
    for name in ("rfm_segments", "window_ntile", "surrogate_keys", "order_line_number"):
        plan = _plan(registry.run(name, spark, SF_SMALL))
        assert "RowNumber" not in plan and "NTile" not in plan, name


def _hot_part_tables(spark, folder):
    """The raw tables with a third of the lines on part 1."""
    from pyspark.sql import functions as F
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "lineitem":
            t = t.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")))
        t.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["product_performance", "join_star", "top_products"])
def test_hot_part_is_split(spark, tmp_path, name):
    sf = _hot_part_tables(spark, str(tmp_path))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def plan():
        df = registry.run(name, spark, sf)
        df.collect()
        return _plan(df)

    old = {k: spark.conf.get(k) for k in [*conf, "spark.sql.adaptive.forceOptimizeSkewedJoin"]}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert "skew=true" in plan()
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert "skew=true" not in plan()     # control
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lines_with_unknown_references_stay(spark, tmp_path):
    from pyspark.sql import functions as F
    from duka.sources.warehouse import Warehouse
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "region":
            t = t.withColumn("r_name", F.when(F.col("r_regionkey") == 0, "ATLANTIS").otherwise(F.col("r_name")))
        if name == "part":
            t = t.where("p_partkey <> 1")
        if name == "customer":
            t = t.where("c_custkey <> 4")
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    w = Warehouse(spark, str(tmp_path))
    lines = w.sales_lines
    assert lines.count() == w.table("lineitem").count()
    got = lines.agg(F.count_if(F.expr("country = 'ATLANTIS'")).alias("far"),
                    F.count_if(F.expr("country = 'ATLANTIS' AND local_currency IS NOT NULL")).alias("priced"),
                    F.count_if(F.expr("product_key = 1 AND unit_price_local IS NULL")).alias("partless"),
                    F.count_if(F.expr("product_key = 1")).alias("part1")).first()
    assert got.far > 0 and got.priced == 0 and got.partless == got.part1 > 0
