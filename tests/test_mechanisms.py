"""Cut points, stable keys, interval cells and exact ratios against brute force."""

import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from duka.functions.money import ratio
from duka.operators import cutpoints, ranges
from duka.plans import registry
from duka.sources.keys import KeyMap
from duka.sources.literals import literal_table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("n,tiles,bins,few", [(0, 4, 16, 0), (1, 4, 16, 0), (3, 4, 4, 0), (10, 4, 3, 2), (1000, 4, 16, 0),
                                              (1000, 4, 64, 30), (1003, 7, 4096, 1024)])
def test_ntiles_equal_the_window(spark, n, tiles, bins, few):
    rng = random.Random(n)
    rows = [(k * 3 - 50, rng.choice([0, 1, 1, 5]), rng.choice([None, *range(-4, 4)]), rng.randint(-10**15, 10**15)) for k in range(n)]
    df = spark.createDataFrame(rows, "k bigint, few bigint, signed bigint, wide bigint").repartition(3)
    got = cutpoints.ntiles(df, tiles, {c: F.col(f"`{c}`") for c in ("few", "signed", "wide")} | {"down": -F.col("few")}, "k", bins, few)
    want = df
    for c, order in {"few": "few", "signed": "signed", "wide": "wide", "down": "-few"}.items():
        want = want.withColumn(f"_{c}", F.ntile(tiles).over(Window.orderBy(F.expr(order).asc_nulls_first(), "k")))
    names = ["few", "signed", "wide", "down"]
    assert Counter(tuple(r) for r in got.select("k", *names).collect()) \
        == Counter(tuple(r) for r in want.select("k", *[f"_{c}" for c in names]).collect())


def test_rfm_has_no_sort_below_its_result(spark):
    df = registry.run("rfm_segments", spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Sort") == 1 and "Join" in plan
    assert "RepartitionByExpression" not in plan


def test_keys_stay_over_reloads(spark, tmp_path):
    keys = KeyMap(spark, str(tmp_path), ["a", "b"], "sk")
    rows = [(f"n{k % 40}", None if k % 7 == 0 else k % 5) for k in range(200)]
    first = keys.assign(spark.createDataFrame(rows, "a string, b int"), "load 1")
    one = {(r.a, r.b): r.sk for r in first.collect()}
    assert first.count() == 200 and sorted(one.values()) == list(range(1, len(set(rows)) + 1))
    more = rows + [("new", 1), ("new", None), (None, None)]
    two = {(r.a, r.b): r.sk for r in keys.assign(spark.createDataFrame(more, "a string, b int"), "load 2").collect()}
    assert {k: two[k] for k in one} == one
    assert sorted(two[k] for k in two.keys() - one.keys()) == [len(one) + 1, len(one) + 2, len(one) + 3]
    # a replayed load numbers nothing
    again = {(r.a, r.b): r.sk for r in keys.assign(spark.createDataFrame(more, "a string, b int"), "load 2").collect()}
    assert again == two
    assert KeyMap(spark, str(tmp_path / "none"), ["a"], "sk").known() is None


def _day(n):
    return dt.date(1900, 1, 1) + dt.timedelta(n)


def test_cells_cover_the_span_once(spark):
    rng = random.Random(4)
    spans = [(0, 0), (0, 36_499), (5, 4), (36_525, 73_050)] + [(a := rng.randint(0, 40_000), a + rng.randint(0, 400)) for _ in range(60)]
    df = spark.createDataFrame([(i, _day(a), _day(b)) for i, (a, b) in enumerate(spans)], "i int, a date, b date")
    cells = ranges.cover(df, "a", "b").select("i", "cell.*").collect()
    base = (_day(0) - dt.date(1, 1, 1)).days
    for i, (a, b) in enumerate(spans):
        own = [(r.level, r.number) for r in cells if r.i == i]
        days = sorted(d for level, number in own for d in range(number << level, (number + 1) << level))
        assert days == list(range(base + a, base + b + 1))
        assert len(own) <= 40      # not one per day


def test_interval_join_equals_the_exploded_form(spark):
    rng = random.Random(6)
    points = [(i, None if i % 50 == 0 else _day(rng.randint(0, 3000))) for i in range(400)]
    spans = [(i, _day(a := rng.randint(0, 3000)), None if i % 20 == 0 else _day(a + rng.choice([-3, 0, 1, 30, 2000]))) for i in range(60)]
    p, s = spark.createDataFrame(points, "p int, d date"), spark.createDataFrame(spans, "s int, a date, b date")
    got = ranges.interval_join(p, "d", s, "a", "b")
    assert got.columns == ["p", "d", "s", "a", "b"]
    want = Counter((i, j) for i, d in points for j, a, b in spans if d and b and a <= d <= b)
    assert Counter((r.p, r.s) for r in got.collect()) == want


def test_ratio_is_exact_at_any_size(spark):
    rng = random.Random(8)
    pairs = [(rng.choice([1, -1]) * rng.randint(0, 10 ** rng.randint(1, 26)), rng.choice([1, -1]) * rng.randint(1, 10 ** rng.randint(1, 26)))
             for _ in range(400)] + [(5, 0), (10**17, 3), (10**17 - 1, 10**17), (1, 200), (-1, 200), (0, 7)]
    rows = [(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in pairs]
    df = literal_table(spark, rows, [("a", "decimal(38,2)"), ("b", "decimal(38,2)")])
    for scale, times in ((2, 1), (2, 100), (4, 1)):
        got = [r.r for r in df.select(ratio("a", "b", scale=scale, times=times).alias("r")).collect()]
        with localcontext() as c:
            c.prec = 120
            want = [None if b == 0 else (Decimal(a) * times / Decimal(b)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
                    for a, b in pairs]
        assert got == want
