"""Customer versions in the star: the as-of merge, version keys, the current version's lines."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from duka.operators import asof, numbering
from duka.plans import procedures, registry
from duka.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL

DAY0 = dt.date(2000, 1, 1)
FACTS = "fid int, k int, d date, v string"
VERSIONS = "key int, since date, name string, n int"


def _day(n):
    return None if n is None else DAY0 + dt.timedelta(n)


def _brute(facts, versions):
    out = []
    for fid, k, d, v in facts:
        open_ = [(s, name, n) for key, s, name, n in versions
                 if k is not None and d is not None and key == k and s is not None and s <= d]
        out.append((fid, k, d, v, *(max(open_)[1:] if open_ else (None, None))))
    return Counter(out)


def _merge(spark, facts, versions, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof.asof_merge(spark.createDataFrame(facts, FACTS), "k", "d", spark.createDataFrame(versions, VERSIONS),
                              "key", "since", ["name", "n"])
        assert got.columns == ["fid", "k", "d", "v", "name", "n"]
        return Counter(tuple(r) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_asof_merge(spark, parts):
    rng = random.Random(parts)
    versions = [(rng.randint(0, 30), _day(rng.randint(0, 100)), rng.choice("abc"), i) for i in range(60)] + [(None, DAY0, "x", 0), (1, None, "y", 1)]
    facts = [(i, rng.choice([None, *range(35)]), _day(rng.choice([None, *range(120)])), "same") for i in range(700)]
    assert _merge(spark, facts, versions, parts) == _brute(facts, versions)


def test_asof_merge_of_a_hot_key(spark):
    # key 5 holds most facts, half of them on one day, so its rows span many ranges
    rng = random.Random(1)
    versions = [(5, _day(n), f"v{n}", n) for n in (0, 40, 41, 90)] + [(k, _day(0), "only", k) for k in range(20) if k != 5]
    facts = [(i, 5, _day(60 if i % 2 else rng.randint(0, 120)), "hot") for i in range(3000)] \
        + [(i, i % 20, _day(rng.randint(0, 120)), "") for i in range(3000, 4000)]
    assert _merge(spark, facts, versions, 16) == _brute(facts, versions)


def test_asof_merge_splits_a_hot_key(spark, monkeypatch):
    seen = []

    def spy(df):
        out = numbering.write_table(df)
        seen.append(out)
        return out

    monkeypatch.setattr(asof, "write_table", spy)
    facts = [(i, 5, _day(60), "hot") for i in range(4000)]
    _merge(spark, facts, [(5, DAY0, "v", 1)], 16)
    sizes = [r["count"] for r in seen[0].where("_k = 5").groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1000


def test_asof_merge_without_rows(spark):
    assert _merge(spark, [], [(1, DAY0, "v", 1)], 4) == Counter()
    assert _merge(spark, [(1, 1, DAY0, "")], [], 4) == Counter({(1, 1, DAY0, "", None, None): 1})


def test_every_line_points_at_the_version_of_its_day(spark):
    w = Warehouse(spark, SF_SMALL)
    fact = w.fact_sales_keyed.select("customer_key", "order_date", "customer_version_key")
    v = w.customer_versions.select("customer_version_key", F.col("customer_key").alias("ck"), "valid_from", "valid_to")
    assert fact.where("customer_version_key IS NULL").count() == 0
    bad = fact.join(v, "customer_version_key").where(
        "ck <> customer_key OR order_date < valid_from OR order_date > coalesce(valid_to, DATE'9999-12-31')")
    assert bad.count() == 0 and fact.join(v, "customer_version_key").count() == fact.count()
    assert v.count() == v.select("customer_version_key").distinct().count()


def test_lifetime_value_counts_the_current_version(spark):
    w = Warehouse(spark, SF_SMALL)
    some = w.customer_versions.where("NOT is_current").select("customer_id").distinct().orderBy("customer_id").first()[0]
    got = procedures.customer_lifetime_value(w, some).first()
    key = some - 2001
    since = w.customer_versions.where(f"customer_key = {key} AND is_current").first().valid_from
    lines = w.sales_lines.where(f"customer_key = {key}")
    want = lines.where(F.col("order_date") >= F.lit(since)).agg(
        F.countDistinct("order_id").alias("o"), F.sum("quantity").alias("q")).first()
    assert (got.total_orders_placed, got.total_items_purchased) == (want.o, want.q)
    assert lines.agg(F.sum("quantity")).first()[0] > want.q


def test_current_version_predicate_reaches_the_store(spark, tmp_path):
    from duka.sources.store import build_warehouse
    build_warehouse(Warehouse(spark, SF_SMALL), str(tmp_path))
    df = registry.run("customer_lifetime_value", spark, SF_SMALL, store_dir=str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "customer_version_key" in plan and "EqualTo(customer_key,4)" in plan


def test_fact_keys_of_hot_orders(spark):
    """Orders above the limit take the distributed path; the keys are the same."""
    plain = Warehouse(spark, SF_SMALL).fact_sales_keyed
    hot = Warehouse(spark, SF_SMALL, hot_order_lines=3).fact_sales_keyed
    keys = ["sales_fact_key", "order_id", "order_line_number", "line_number", "product_key", "customer_version_key"]
    rows = sorted(map(tuple, plain.select(keys).collect()))
    assert rows == sorted(map(tuple, hot.select(keys).collect()))
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    assert max(r[2] for r in rows) > 3


def test_running_totals(spark):
    rng = random.Random(11)
    rows = [(k, rng.randint(0, 9)) for k in rng.sample(range(1000), 300)]
    got = numbering.running_totals(spark.createDataFrame(rows, "k int, v int").repartition(5), [F.col("k")], "v", "t").collect()
    total, want = 0, {}
    for k, v in sorted(rows):
        want[k] = total
        total += v
    assert {r.k: r.t for r in got} == want


def test_lines_are_not_shuffled_for_their_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = Warehouse(spark, SF_SMALL).fact_sales_keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # numbered where the join to the orders has dealt them
    assert plan.count("Window [row_number()") == 1
    after = plan[plan.index("Window [row_number()"):]
    assert "Exchange" not in after[:after.index("SortMergeJoin")]
    assert "rangepartitioning(l_orderkey" not in plan
