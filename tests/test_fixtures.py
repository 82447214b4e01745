"""Hand fixtures with answers worked out by arithmetic (FIXTURES.md section 3)."""

from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal
from duka.functions.localize import line_measures
from duka.functions.money import pct, ratio
from duka.operators import antijoin, numbering, pairs
from duka.plans import analytics, measures, procedures, views
from duka.sources.literals import literal_table
from tests.helpers import FixtureWarehouse, products, sales


def _one_col(df, col):
    return [r[col] for r in df.collect()]


def test_week_number_sunday_weeks(spark):
    days = ["2022-01-01", "2022-01-02", "2023-12-31", "2024-12-31"]
    df = literal_table(spark, [(d,) for d in days], [("d", "date")])
    got = df.select(cal.sunday_week_number("d").alias("w")).collect()
    assert [r.w for r in got] == [1, 2, 53, 53]


def test_fiscal_calendar_july_start(spark):
    df = literal_table(spark, [("2024-06-30",), ("2024-07-01",)], [("d", "date")])
    got = df.select(cal.fiscal_month("d").alias("m"), cal.fiscal_quarter("d").alias("q"),
                    cal.fiscal_year("d").alias("y")).collect()
    assert [tuple(r) for r in got] == [(12, 4, 2023), (1, 1, 2024)]


def test_weekend(spark):
    df = literal_table(spark, [("2024-01-06",), ("2024-01-08",)], [("d", "date")])
    assert _one_col(df.select(cal.is_weekend("d").alias("w")), "w") == [True, False]


def test_month_boundary_count(spark):
    df = literal_table(spark, [("2024-01-01", "2024-02-28"), ("2024-01-31", "2024-02-01")],
                       [("a", "date"), ("b", "date")])
    assert _one_col(df.select(cal.month_boundaries_between("a", "b").alias("m")), "m") == [1, 1]


def test_fx_stored_at_four_decimals(spark):
    w = FixtureWarehouse(spark)
    got = {r.local_currency: r.fx for r in
           w.market_policy.select("local_currency", F.col("fx_rate").cast("decimal(18,4)")
                                  .alias("fx")).collect()}
    assert got["KES"] == D("0.0077") and got["TZS"] == D("0.0004")
    assert got["UGX"] == D("0.0003") and got["RWF"] == D("0.0008")


def test_line_measures_uganda(spark):
    rows = [(2, D("92463.00"), D("29600.00"), D("0.00"), D("0.18"), D("0.0003"))]
    df = literal_table(spark, rows, [
        ("quantity", "int"), ("unit_price_local", "decimal(18,2)"),
        ("product_cost_local", "decimal(18,2)"), ("discount_rate", "decimal(4,2)"),
        ("vat_rate", "decimal(4,2)"), ("exchange_rate_to_usd", "decimal(18,4)")])
    r = line_measures(df).collect()[0]
    assert r.line_amount_local == D("184926.00")
    assert r.gross_revenue_usd == D("55.48")
    assert r.tax_amount_local == D("16643.34") and r.tax_usd == D("4.99")
    assert r.profit_usd == D("37.72")


def test_growth_rates_guard_zero_base(spark):
    df = literal_table(spark, [(1, D("100")), (2, D("150")), (3, D("0")), (4, D("30"))],
                       [("m", "int"), ("v", "decimal(18,2)")])
    prev = F.lag("v").over(Window.orderBy("m"))
    got = _one_col(df.select(pct(F.col("v") - prev, prev).alias("g")).orderBy("m"), "g")
    assert got == [None, D("50.00"), D("-100.00"), None]


def test_ratio_rounds_half_away_from_zero(spark):
    df = literal_table(spark, [(D("1.005"), D("1")), (D("-1.005"), D("1")), (D("2"), D("3"))],
                       [("a", "decimal(18,3)"), ("b", "decimal(18,2)")])
    # operands are money (2 decimals): 1.005 is first cast to 1.01 / -1.01
    got = _one_col(df.select(ratio("a", "b").alias("r")), "r")
    assert got == [D("1.01"), D("-1.01"), D("0.67")]


def test_ntile_sizes(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    t = numbering.ntile(df, 4, [F.col("k")], "t").orderBy("k")
    assert _one_col(t, "t") == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


def test_not_in_null_semantics(spark):
    left = literal_table(spark, [(1,), (2,), (3,), (None,)], [("k", "bigint")])
    with_null = literal_table(spark, [(2,), (None,)], [("s", "bigint")])
    no_null = literal_table(spark, [(2,)], [("s", "bigint")])
    empty = no_null.where(F.lit(False))
    assert antijoin.not_in(left, "k", with_null, "s").count() == 0
    assert sorted(_one_col(antijoin.not_in(left, "k", no_null, "s"), "k")) == [1, 3]
    assert antijoin.not_in(left, "k", empty, "s").count() == 4
    assert sorted(_one_col(antijoin.anti_join(left, "k", with_null, "s").where("k is not null"),
                           "k")) == [1, 3]


def test_basket_counts_line_pairs(spark):
    lines = literal_table(spark, [(1, 1), (1, 1), (1, 2)], [("o", "bigint"), ("p", "bigint")])
    got = pairs.pair_counts(lines, "o", "p").collect()
    assert [(r.item_a, r.item_b, r.times) for r in got] == [(1, 2, 2)]


def _roi_warehouse(spark):
    s = sales(spark, [(i, 1, 1, "2024-01-10", 1, 1, D("20.00"), 2) for i in range(3)])
    mkt = literal_table(spark, [(20240110, 2, 100, 10, 1, D("0"), D("10.00"))], [
        ("date_key", "int"), ("campaign_key", "int"), ("impressions", "int"), ("clicks", "int"),
        ("conversions", "int"), ("revenue_generated", "decimal(18,2)"), ("cost", "decimal(18,2)")])
    return FixtureWarehouse(spark, sales=s, marketing=mkt)


def test_campaign_roi_fan_out_literal(spark):
    r = procedures.campaign_roi(_roi_warehouse(spark), "Facebook Ads").collect()[0]
    assert r.total_campaign_cost_usd == D("30.00") and r.attribution_revenue_usd == D("60.00")
    assert r.return_on_investment_ratio == D("1.00") and r.impressions == 300


def test_campaign_roi_deduplicated(spark):
    r = procedures.campaign_roi_deduplicated(_roi_warehouse(spark), "Facebook Ads").collect()[0]
    assert r.total_campaign_cost_usd == D("10.00") and r.attribution_revenue_usd == D("60.00")
    assert r.return_on_investment_ratio == D("5.00") and r.ctr_pct == D("10.000")


def test_campaign_cost_spread(spark):
    w = FixtureWarehouse(spark, first_year=2025, last_year=2026)
    c = literal_table(spark, [(1, D("5000.00"), "2025-11-20", "2025-11-30"),
                              (2, D("100.00"), "2025-12-01", "2025-12-01")],
                      [("campaign_key", "int"), ("campaign_cost", "decimal(18,2)"),
                       ("start_date", "date"), ("end_date", "date")])
    w.__dict__["dim_campaign"] = c
    days = w.campaign_days
    got = days.groupBy("campaign_key").agg(F.count("*").alias("n"), F.sum("cost").alias("c"),
                                           F.max("cost").alias("m")).orderBy("campaign_key").collect()
    assert (got[0].n, got[0].c, got[0].m) == (11, D("5500.00"), D("500.00"))
    assert got[1].n == 1 and got[1].m is None


def test_cohort_split_statuses(spark):
    # first order cancelled in January, completed order in February
    s = sales(spark, [(1, 7, 1, "2024-01-05", 3, 1, D("5.00"), 1),
                      (2, 7, 1, "2024-02-03", 1, 1, D("5.00"), 1)])
    r = analytics.cohort_retention(FixtureWarehouse(spark, sales=s)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.cohort, r.cohort_size, r.month_0_active, r.month_1_retained) == ("2024-01", 1, 0, 1)
    assert r.month_1_retention_rate_pct == D("100.00")


def _inventory(spark, rows):
    return literal_table(spark, rows, [
        ("date_key", "int"), ("product_key", "bigint"), ("opening_stock", "int"),
        ("stock_received", "int"), ("stock_sold", "int"), ("stock_returned", "int"),
        ("closing_stock", "int")])


def test_semi_additive_stock(spark):
    inv = _inventory(spark, [(20240101, 1, 150, 0, 0, 0, 10), (20240102, 1, 150, 0, 10, 0, 20),
                             (20240103, 1, 150, 0, 0, 0, 5)])
    p = products(spark, [(1, "thing", "CAT", D("1.00"))])
    w = FixtureWarehouse(spark, inventory=inv, products=p)
    v = views.inventory_analytics(w).collect()[0]
    assert v.current_stock_on_hand == 35
    e = measures.ending_inventory(w).collect()[0]
    assert e.ending_stock == 5


def test_stock_health_labels(spark):
    inv = _inventory(spark, [(20240101, 1, 150, 0, 0, 0, 5), (20240101, 2, 150, 0, 10, 0, 31),
                             (20240101, 3, 150, 0, 10, 0, 30)])
    p = products(spark, [(1, "a", "C", D("1.00")), (2, "b", "C", D("1.00")),
                         (3, "c", "C", D("1.00"))])
    got = {r.product_name: r.stock_health_status
           for r in views.inventory_analytics(FixtureWarehouse(spark, inventory=inv, products=p))
           .collect()}
    assert got == {"a": "Dead Stock (No Sales)", "b": "Overstocked", "c": "Healthy Turnover"}


def test_return_rate(spark):
    s = sales(spark, [(1, 1, 1, "2024-01-05", 2, 1, D("5.00"), 1),
                      (2, 1, 1, "2024-01-05", 1, 7, D("5.00"), 1)])
    p = products(spark, [(1, "a", "C", D("1.00"))])
    r = analytics.returned_products(FixtureWarehouse(spark, sales=s, products=p)).collect()[0]
    assert r.return_rate_pct == D("12.50") and r.total_units_kept == 7


def test_divide_or_zero(spark):
    s = sales(spark, [(1, 1, 1, "2024-01-05", 2, 1, D("5.00"), 1)])
    r = measures.returns_liability(FixtureWarehouse(spark, sales=s)).collect()[0]
    assert r.returned_usd == D("5.00") and r.settled_usd is None
    assert r.active_revenue_risk == D("0.0000")


def test_rolling_12m_ltv(spark):
    rows = []
    for i in range(13):
        y, m = 2023 + (i // 12), i % 12 + 1
        rows.append((i, 1, 1, f"{y}-{m:02d}-10", 1, 1, D("12.00"), 1))
    rows[-1] = (12, 1, 1, "2024-01-10", 1, 1, D("6.00"), 1)
    rows.append((13, 2, 1, "2024-01-11", 1, 1, D("6.00"), 1))
    s = sales(spark, rows)
    got = measures.rolling_12m_ltv(FixtureWarehouse(spark, sales=s)) \
        .where("year = 2024 and month_number = 1").collect()[0]
    assert got.trailing_12m_revenue_usd == D("144.00") and got.active_customers == 2
    assert got.rolling_12m_ltv_usd == D("72.00")


def test_ratio_on_very_large_totals(spark):
    big = D("123456789012345678901.23")  # beyond decimal(20,2)
    df = literal_table(spark, [(big, D("2.00")), (D("1.00"), D("3.00"))],
                       [("a", "decimal(38,2)"), ("b", "decimal(38,2)")])
    got = _one_col(df.select(ratio("a", "b").alias("r")), "r")
    assert got == [D("61728394506172839450.62"), D("0.33")]
