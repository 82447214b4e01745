"""Atomic publishing: half-written loads stay unseen, replayed batches change nothing, batches merge."""

import datetime as dt
import glob
import os
import random

import pytest

from duka.operators import scd2
from duka.sources import store
from duka.sources.history import History
from duka.sources.publish import Published
from duka.sources.warehouse import Warehouse
from duka.streaming import marketing
from tests.conftest import SF_SMALL


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(a.columns).collect()), key=str)


def test_a_build_that_dies_leaves_the_old_star(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    w = Warehouse(spark, SF_SMALL)
    store.build_warehouse(w, out)
    before = store.StoredWarehouse(spark, out, SF_SMALL)
    lines = before.sales_lines.count()
    write, written = store._write, []

    def dying(df, path, *args, **kw):
        write(df, path, *args, **kw)
        written.append(path)
        if "dim_product" in path:
            raise OSError("killed")

    monkeypatch.setattr(store, "_write", dying)
    with pytest.raises(OSError):
        store.build_warehouse(w, out)
    assert written      # some tables were written
    after = store.StoredWarehouse(spark, out, SF_SMALL)
    assert after.folders == before.folders and after.sales_lines.count() == lines
    monkeypatch.setattr(store, "_write", write)
    store.build_warehouse(w, out)
    third = store.StoredWarehouse(spark, out, SF_SMALL)
    assert not set(third.folders.values()) & set(before.folders.values())
    # the reader that was there before keeps its own tables
    assert before.sales_lines.count() == third.sales_lines.count() == lines


def test_nothing_published(spark, tmp_path):
    assert Published(spark, str(tmp_path / "none")).folders() == {}
    assert not Published(spark, str(tmp_path / "none")).has("x")


def test_a_stream_batch_that_dies_or_is_replayed(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, SF_SMALL)
    out, checkpoint = str(tmp_path / "fact"), str(tmp_path / "checkpoint")
    publish = Published.publish

    def dying(self, folders, batch):
        raise OSError("killed")

    monkeypatch.setattr(Published, "publish", dying)
    with pytest.raises(Exception):
        marketing.load_fact_marketing(w, SF_SMALL, out, checkpoint, "events.parquet")
    assert Published(spark, out).folders() == {}
    monkeypatch.setattr(Published, "publish", publish)
    marketing.load_fact_marketing(w, SF_SMALL, out, checkpoint, "events.parquet")    # the batch again
    p = Published(spark, out)
    first = p.folders()
    assert _same(w.fact_marketing, p.table("fact_marketing"))
    assert p.has(f"{checkpoint}#0")
    marketing.load_fact_marketing(w, SF_SMALL, out, checkpoint, "events.parquet")    # nothing new
    assert p.folders() == first


KEYS = "k int, d date, a string"


def _observations(rng, n):
    return [(rng.randint(0, 60), dt.date(2000, 1, 1) + dt.timedelta(rng.randint(0, 40)), rng.choice(["x", "y", None])) for _ in range(n)]


def test_batches_equal_one_build(spark, tmp_path):
    rng = random.Random(2)
    rows = list({r[:2]: r for r in _observations(rng, 300)}.values())
    rng.shuffle(rows)
    history = History(spark, str(tmp_path), "k", "d", "a", buckets=4)
    for i in range(3):      # late observations and keys of earlier batches among them
        history.apply(spark.createDataFrame(rows[i::3], KEYS), f"batch {i}")
    want = scd2.build_versions(spark.createDataFrame(rows, KEYS), "k", "d", "a")
    assert _same(want, history.versions())


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    history = History(spark, str(tmp_path), "k", "d", "a", buckets=8)
    day = dt.date(2000, 1, 1)
    history.apply(spark.createDataFrame([(k, day, "x") for k in range(100)], KEYS), "first")
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/data/**/*.parquet", recursive=True)}
    folders = history.published.folders()
    touched = history.apply(spark.createDataFrame([(7, day + dt.timedelta(9), "y")], KEYS), "second")
    assert len(touched) == 1
    now = history.published.folders()
    assert {n for n in now if now[n] != folders[n]} == {f"observations/{touched[0]}", f"versions/{touched[0]}"}
    assert all(os.stat(f).st_mtime_ns == s for f, s in stamps.items())
    assert history.versions().count() == 101
    # what the second batch replaced can go
    assert history.published.remove_replaced() == sorted(
        folders[n].removeprefix(f"{tmp_path}/data/") for n in now if now[n] != folders[n])
    assert history.versions().count() == 101 and history.published.folders() == now
    assert history.published.remove_replaced() != []      # named in the log for good
    # the same batch again, and an empty one
    assert history.apply(spark.createDataFrame([(7, day, "z")], KEYS), "second") == []
    assert history.apply(spark.createDataFrame([], KEYS), "third") == []
    assert history.published.folders() == now


def test_a_later_batch_corrects_a_day(spark, tmp_path):
    history = History(spark, str(tmp_path), "k", "d", "a", buckets=2)
    day = dt.date(2000, 1, 1)
    history.apply(spark.createDataFrame([(1, day, "x"), (1, day + dt.timedelta(1), "y")], KEYS), "first")
    history.apply(spark.createDataFrame([(1, day + dt.timedelta(1), "x")], KEYS), "second")
    assert [(r.a, r.is_current) for r in history.versions().collect()] == [("x", True)]


def test_one_customer_reads_few_row_groups(spark, tmp_path):
    from pyspark.sql import functions as F
    lines = spark.range(200_000).select((F.col("id") * 7919 % 100_003).alias("customer_key"), F.col("id").alias("v"))
    store._write(lines.repartition(16), str(tmp_path / "fact"), look_up="customer_key")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.read.parquet(str(tmp_path / "fact")).where("customer_key = 4711")
        found = df.count(), df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        rows = scan.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found[0] == 2 and len(found[1]) == 2
    assert 2 <= rows <= 200_000 // 4
