"""Incremental marketing load: two arrivals of event files equal one batch build."""

from pyspark.sql import functions as F

from duka.sources.publish import Published
from duka.sources.warehouse import Warehouse
from duka.streaming.marketing import load_fact_marketing
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_load_equals_batch(spark, tmp_path):
    w = Warehouse(spark, SF_SMALL)
    events = w.table("events")
    mid = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    out = str(tmp_path / "fact")
    ckpt = str(tmp_path / "ckpt")
    # first arrival: only the early events
    events.where(F.col("ts") < mid).coalesce(1).write.parquet(str(tmp_path / "drop1"))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i, f in enumerate(sorted((tmp_path / "drop1").glob("*.parquet"))):
        f.rename(inbox / f"events-a{i}.parquet")
    load_fact_marketing(w, str(inbox), out, checkpoint=ckpt)
    first_total = Published(spark, out).table("fact_marketing").agg(F.sum("impressions")).collect()[0][0]
    # second arrival: the rest; the same checkpoint resumes from the state
    events.where(F.col("ts") >= mid).coalesce(1).write.parquet(str(tmp_path / "drop2"))
    for i, f in enumerate(sorted((tmp_path / "drop2").glob("*.parquet"))):
        f.rename(inbox / f"events-b{i}.parquet")
    load_fact_marketing(w, str(inbox), out, checkpoint=ckpt)
    final = Published(spark, out).table("fact_marketing")
    assert _same(final, w.fact_marketing)
    assert first_total < final.agg(F.sum("impressions")).collect()[0][0]
