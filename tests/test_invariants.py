
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duka.functions import fixed
from duka.plans import registry
from duka.sources.warehouse import Warehouse
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse(spark, SF_CHECK)


def _one(df, col):
    return df.collect()[0][col]


def test_revenue_months_add_up_to_the_fact(w):
    kpis = registry.PLANS["revenue_kpis"](w)
    by_month = _one(kpis.agg(F.sum("net_revenue_usd").alias("s")), "s")
    excluded = fixed.status_keys("Cancelled", "Refunded")
    total = _one(w.sales_lines.where(~F.col("status_key").isin(*excluded))
                 .agg(F.sum("net_revenue_usd").alias("s")), "s")
    assert by_month == total


def test_cohort_month_zero_within_cohort_size(w):
    c = registry.PLANS["cohort_retention"](w)
    assert c.where("month_0_active > cohort_size or month_1_retained > cohort_size").count() == 0
    # every customer with a completed purchase is in exactly one cohort
    completed = w.sales_lines.where(F.col("status_key") == 1).select("customer_key").distinct().count()
    assert _one(c.agg(F.sum("cohort_size").alias("s")), "s") == completed


def test_ntile_sizes_differ_by_at_most_one(w):
    q = registry.PLANS["window_ntile"](w).groupBy("quartile").count().collect()
    sizes = sorted(r["count"] for r in q)
    assert len(sizes) == 4 and sizes[-1] - sizes[0] <= 1


def test_basket_pairs_in_one_key_order(w):
    k = registry.PLANS["market_basket_keys"](w)
    assert k.where("product_a >= product_b").count() == 0
    rev = k.select(F.col("product_b").alias("product_a"), F.col("product_a").alias("product_b"))
    assert k.join(rev, ["product_a", "product_b"]).count() == 0


def test_deduplicated_roi_cost_equals_marketing_cost(w):
    roi = registry.PLANS["campaign_roi_deduplicated"](w)
    cost = _one(roi.agg(F.sum("total_campaign_cost_usd").alias("c")), "c")
    key = [k for k, _, ch, _ in fixed.CAMPAIGNS if ch == fixed.DEFAULTS["channel"]]
    expect = _one(w.fact_marketing.where(F.col("campaign_key").isin(*key))
                  .agg(F.sum("cost").alias("c")), "c")
    assert cost == expect
    literal = registry.PLANS["campaign_roi"](w)
    assert _one(literal, "total_campaign_cost_usd") >= cost


def test_market_basket_equals_naive_line_self_join(w):
    fast = registry.PLANS["market_basket_keys"](w)
    s = w.sales_lines.select("order_id", "product_key")
    a, b = s.alias("a"), s.alias("b")
    naive = (a.join(b, (F.col("a.order_id") == F.col("b.order_id"))
                    & (F.col("a.product_key") < F.col("b.product_key")))
             .groupBy(F.col("a.product_key").alias("product_a"),
                      F.col("b.product_key").alias("product_b"))
             .agg(F.count("*").alias("times_purchased_together")))
    assert fast.exceptAll(naive).count() == 0 and naive.exceptAll(fast).count() == 0


def test_not_in_and_left_anti_agree_on_non_null_keys(w):
    a = registry.PLANS["anti_join_not_in"](w)
    b = registry.PLANS["anti_join_left_anti"](w)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_inventory_ending_stock_is_last_day_not_sum(w):
    e = registry.PLANS["ending_inventory"](w).where("year = 2001 AND month_number = 1")
    inv = w.fact_inventory().join(w.dim_product.select("product_key", "category"), "product_key")
    last = (inv.where(F.col("date_key") == 20010131).groupBy("category")
            .agg(F.sum("closing_stock").alias("s")))
    got = {r.category: r.ending_stock for r in e.collect()}
    assert got == {r.category: r.s for r in last.collect()}


def test_scd2_versions_do_not_overlap(w):
    v = registry.PLANS["scd2_build"](w)
    assert v.where("valid_to is not null and valid_to < valid_from").count() == 0
    assert v.where("is_current").count() == v.select("customer_key").distinct().count()
    assert _one(v.groupBy("customer_key").agg(F.sum(F.col("is_current").cast("int")).alias("c"))
                .agg(F.max("c").alias("m")), "m") == 1


def test_fx_rates_are_four_decimals(w):
    rates = {r.exchange_rate_to_usd for r in
             w.sales_lines.select("exchange_rate_to_usd").distinct().collect()}
    assert rates <= {Decimal("0.0077"), Decimal("0.0004"), Decimal("0.0003"),
                     Decimal("0.0008"), Decimal("1.0000")}
