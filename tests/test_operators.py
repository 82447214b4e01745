"""Operators on generated inputs, including a key holding a third of all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from duka.operators import numbering, pairs, quality, scd2
from duka.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL


def _skewed(spark, n=3000):
    # key 0 holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id").alias("u"))


def test_dense_index_matches_row_number(spark):
    df = _skewed(spark)
    got = numbering.dense_index(df, [F.col("v"), F.col("u")], "rn")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("v", "u")))
    j = got.join(ref, "u")
    assert j.where("rn != ref").count() == 0
    assert got.count() == 3000


def test_number_within_groups_on_hot_key(spark):
    # group NULL is large as well; a limit of 100 sends both over ranges, the default none
    df = _skewed(spark).withColumn("g", F.when(F.col("u") % 7 == 0, None).otherwise(F.col("g")))
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("v", "u")))
    for limit in (100, numbering.HOT_GROUP):
        got = numbering.number_within_groups(df, ["g"], [F.col("v"), F.col("u")], "rn", limit=limit)
        assert got.count() == 3000 and got.join(ref, "u").where("rn != ref").count() == 0


def test_ntile_matches_builtin(spark):
    df = _skewed(spark, 1001)
    got = numbering.ntile(df, 4, [F.desc("v"), F.col("u")], "t")
    ref = df.withColumn("ref", F.ntile(4).over(Window.orderBy(F.desc("v"), "u")))
    assert got.join(ref, "u").where("t != ref").count() == 0


def test_pair_counts_equal_naive_self_join(spark):
    lines = spark.range(600).select((F.col("id") % 40).alias("o"), (F.col("id") * 13 % 17).alias("p"))
    fast = pairs.pair_counts(lines, "o", "p")
    a, b = lines.alias("a"), lines.alias("b")
    naive = (a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") < F.col("b.p")))
             .groupBy(F.col("a.p").alias("item_a"), F.col("b.p").alias("item_b"))
             .agg(F.count("*").alias("times")))
    assert fast.exceptAll(naive).count() == 0 and naive.exceptAll(fast).count() == 0


def test_scd2_versions_only_on_change(spark):
    obs = spark.createDataFrame(
        [(1, "2020-01-01", "A"), (1, "2021-01-01", "A"), (1, "2022-01-01", "B"),
         (2, "2020-01-01", "C")], "k int, d string, t string").withColumn("d", F.to_date("d"))
    v = scd2.build_versions(obs, "k", "d", "t").orderBy("k", "version").collect()
    assert [(r.k, r.t, str(r.valid_from), str(r.valid_to), r.is_current) for r in v] == [
        (1, "A", "2020-01-01", "2021-12-31", False), (1, "B", "2022-01-01", "None", True),
        (2, "C", "2020-01-01", "None", True)]


def test_duplicate_keys_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k int")
    r = quality.duplicate_keys("t(k)", df, ["k"]).collect()[0]
    assert (r.total_rows, r.distinct_keys, r.duplicated_keys, r.rows_in_duplicates) == (6, 3, 2, 5)


def test_catalog_views_run_through_sql(spark):
    from duka.sources.catalog import register_all
    from tests.conftest import SF_SMALL
    names = register_all(spark, SF_SMALL)
    assert "revenue_kpis" in names and "sales_lines" in names
    n = spark.sql("SELECT count(*) AS n FROM revenue_kpis WHERE year = 2000").collect()[0].n
    assert n == 12
    total = spark.sql("SELECT sum(line_count) AS s FROM src_status_values").collect()[0].s
    assert total == spark.sql("SELECT count(*) AS c FROM sales_lines").collect()[0].c


def _hot_basket_lines(spark, n=6000):
    # order 0 holds a third of all lines, each with a distinct product, so it
    # stays hot after the (order, product) pre-aggregation
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("o"),
        F.col("id").alias("p"), F.col("id").alias("u"))


def _with_low_skew_thresholds(spark, fn):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_basket_is_split_by_aqe(spark):
    lines = _hot_basket_lines(spark)

    def run():
        df = pairs.pair_counts(lines, "o", "p", items_per_part=100).agg(F.sum("times").alias("t"))
        total = df.collect()[0][0]
        return total, df._jdf.queryExecution().executedPlan().toString()

    total, plan = _with_low_skew_thresholds(spark, run)
    # tagging the hot basket's rows is split by AQE; its pairs by the parts
    assert "SortMergeJoin(skew=true)" in plan
    a, b = lines.alias("a"), lines.alias("b")
    naive = a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") < F.col("b.p"))).count()
    assert total == naive


def test_hot_order_line_numbers_split(spark):
    lines = _hot_basket_lines(spark)

    def run():
        got = numbering.number_within_groups(lines, ["o"], [F.col("p"), F.col("u")], "rn", limit=100)
        sel = got.select("u", "rn")
        rows = sel.collect()
        return rows, sel._jdf.queryExecution().executedPlan().toString()

    rows, plan = _with_low_skew_thresholds(spark, run)
    ref = lines.withColumn("ref", F.row_number().over(Window.partitionBy("o").orderBy("p", "u")))
    expected = {r.u: r.ref for r in ref.select("u", "ref").collect()}
    assert {r.u: r.rn for r in rows} == expected
    # the join back is keyed by (range partition, order): the hot order is
    # spread over several range partitions, so no join key holds it whole
    assert "SortMergeJoin" in plan and "[_pid" in plan


def _naive_pairs(lines):
    a, b = lines.alias("a"), lines.alias("b")
    return (a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") < F.col("b.p")))
            .groupBy(F.col("a.p").alias("item_a"), F.col("b.p").alias("item_b"))
            .agg(F.count("*").alias("times")))


def test_hot_basket_is_dealt_over_parts(spark):
    lines = _hot_basket_lines(spark)
    per = pairs.basket_items(lines, "o", "p")
    hot = {r.o: r._parts for r in pairs.hot_baskets(per, "o", 100).collect()}
    assert hot == {0: 20}                    # 2,000 distinct items
    df = pairs.pair_counts(lines, "o", "p", items_per_part=100)
    naive = _naive_pairs(lines)
    assert df.exceptAll(naive).count() == 0 and naive.exceptAll(df).count() == 0


def test_every_hot_basket_is_split_and_no_other(spark):
    # 200 baskets of 12 items, 300 of at most 3; repeated lines and NULLs
    lines = spark.range(3300).select(
        F.when(F.col("id") < 2400, F.col("id") % 200).otherwise(1000 + F.col("id") % 300).alias("o"),
        F.when(F.col("id") % 51 != 7, F.col("id")).alias("p"))
    lines = lines.unionAll(lines.where("p % 5 = 0"))
    per = pairs.basket_items(lines, "o", "p")

    def hot():
        return {(r.o, r._parts) for r in pairs.hot_baskets(per, "o", 5).collect()}

    first = hot()
    sizes = {r.o: r.k for r in lines.where("p is not null").groupBy("o")
             .agg(F.count_distinct("p").alias("k")).collect()}
    assert first == {(o, -(-k // 5)) for o, k in sizes.items() if k > 5} and len(first) == 200
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        old = spark.conf.get(key)
        try:
            spark.conf.set(key, value)
            assert hot() == first            # a function of the data alone
        finally:
            spark.conf.set(key, old)
    assert pairs.hot_baskets(per, "o").count() == 0
    df, naive = pairs.pair_counts(lines, "o", "p", items_per_part=5), _naive_pairs(lines)
    assert df.exceptAll(naive).count() == 0 and naive.exceptAll(df).count() == 0
    counted = {r.o: r.n for r in pairs.pairs_per_basket(lines, "o", "p", "n").collect()}
    a, b = lines.alias("a"), lines.alias("b")
    want = a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") < F.col("b.p"))).groupBy("a.o").count()
    assert counted == {r.o: r["count"] for r in want.collect()}


def test_warehouse_tables_match_their_schemas(spark):
    import pytest as _pytest

    from duka.plans.builds import fact_sales
    from duka.sources import schemas
    from duka.sources.warehouse import Warehouse
    from tests.conftest import SF_SMALL
    w = Warehouse(spark, SF_SMALL)
    frames = {n: getattr(w, n) for n in ["dim_date", "dim_location", "dim_customer",
                                         "dim_product", "dim_campaign", "dim_status",
                                         "fact_marketing"]}
    frames["fact_inventory"] = w.fact_inventory()
    frames["fact_sales"] = fact_sales(w)
    for name, df in frames.items():
        schemas.check(df, name)
        assert [f.name for f in df.schema.fields] == [f.name for f in schemas.schema(name).fields]
    with _pytest.raises(ValueError):
        schemas.check(frames["dim_status"].withColumn("status_key", F.col("status_key").cast("long")),
                      "dim_status")


def test_scd2_null_is_a_value(spark):
    from duka.operators.scd2 import build_versions
    rows = [(1, "2024-01-01", "A"), (1, "2024-01-02", None), (1, "2024-01-03", None), (1, "2024-01-04", "A"),
            (2, "2024-01-01", None), (2, "2024-01-05", "B")]
    obs = spark.createDataFrame(rows, "k int, d string, a string").selectExpr("k", "cast(d as date) d", "a")
    got = build_versions(obs, "k", "d", "a").orderBy("k", "version").collect()
    assert [(r.k, r.version, r.a, r.is_current) for r in got] == [
        (1, 1, "A", False), (1, 2, None, False), (1, 3, "A", True), (2, 1, None, False), (2, 2, "B", True)]


def test_parameters_that_are_zero_count(spark):
    from duka.plans.procedures import top_products
    from duka.sources.warehouse import Warehouse
    assert top_products(Warehouse(spark, "/root/testdata/sf0.001"), 0).count() == 0


def test_value_runs_are_the_grid(spark):
    import datetime as dt
    import random
    from duka.operators import ranges
    rng = random.Random(5)
    lo, hi = dt.date(2000, 1, 30), dt.date(2000, 4, 2)
    days = [lo + dt.timedelta(k) for k in range((hi - lo).days + 1)]
    # entities without rows, with rows on both borders, on every day; a row of an unknown entity
    rows = [(1, lo, 5), (1, hi, 0), (9, lo, 1)] + [(2, d, 1) for d in days] \
        + [(3, d, rng.randint(0, 4)) for d in rng.sample(days, 20)]
    daily = spark.createDataFrame(rows, "k int, d date, v int")
    entities = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    runs = ranges.value_runs(entities, "k", daily, "d", "v", lo, hi).collect()
    assert len([r for r in runs if r.k == 4]) == 1 and len([r for r in runs if r.k == 1]) == 3
    value = {(k, d): v for k, d, v in rows}
    want = {(k, d, value.get((k, d))) for k in (1, 2, 3, 4) for d in days}
    assert sum((r.last_day - r.first_day).days + 1 for r in runs) == len(want)
    grid = ranges.dense_daily(entities, "k", daily, "d", "v", lo, hi)
    assert {(r.k, r.full_date, r.v) for r in grid.collect()} == want
    months = ranges.run_months(spark.createDataFrame(runs)).groupBy("month").agg(F.sum("days").alias("n")).collect()
    assert {r.month.month: r.n for r in months} == {1: 8, 2: 29 * 4, 3: 31 * 4, 4: 8}


def test_stock_sums_by_runs_equal_sums_over_days(spark):
    w = Warehouse(spark, SF_SMALL)
    by_day = w.fact_inventory().groupBy("product_key").agg(
        F.count(F.lit(1)).alias("days"), *[F.sum(c).alias(c) for c in ("opening_stock", "stock_sold", "closing_stock")])
    assert sorted(map(tuple, by_day.collect())) == sorted(map(tuple, w.stock_totals().collect()))
    ends = w.fact_inventory().where(F.last_day(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
                                    == F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    assert sorted(map(tuple, ends.select("product_key", "date_key", "closing_stock").collect())) \
        == sorted(map(tuple, w.month_end_stock().collect()))
    runs = w.stock_runs().count()
    lo, hi = w.inventory_span
    sold_days = w.sales_between(lo, hi).select("product_key", "order_date").distinct().count()
    assert runs <= 2 * sold_days + w.dim_product.count()     # not products x days


def test_orphan_counts_scan_each_table_once(spark, tmp_path):
    from duka.plans import quality as plans
    raw = [c for c in plans.ORPHAN_CHECKS if not c[1].startswith("w:") and not c[3].startswith("w:")]
    w = Warehouse(spark, SF_SMALL)
    df = quality.orphan_counts(raw, w.table)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for name in {c[1] for c in raw} | {c[3] for c in raw}:
        assert plan.count(f"{name}.parquet]") == 1, name


def test_orphan_counts_of_odd_keys(spark):
    tables = {"child": spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (7, "z"), (7, "a")], "k int, s string"),
              "parent": spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "k bigint, s string"),
              "none": spark.createDataFrame([], "k int, s string")}
    checks = [("by number", "child", "k", "parent", "k"), ("by text", "child", "s", "parent", "s"),
              ("no parents", "child", "k", "none", "k"), ("nothing", "none", "s", "none", "s")]
    got = {r.check_name: (r.child_rows, r.orphan_rows) for r in quality.orphan_counts(checks, tables.get).collect()}
    assert got == {"by number": (5, 3), "by text": (5, 2), "no parents": (5, 5), "nothing": (0, 0)}
