"""The spark-submit entry point writes a report as Parquet."""

from duka import jobs
from tests.conftest import SF_SMALL


def test_params_are_typed():
    assert jobs._params(["target_year=2000", "channel=Facebook Ads", "x=-3"]) == \
        {"target_year": 2000, "channel": "Facebook Ads", "x": -3}


def test_run_writes_report(spark, tmp_path):
    out = str(tmp_path / "monthly")
    jobs.main(["run", "monthly_revenue", "--sf", SF_SMALL, "--out", out,
               "--param", "target_year=1999"])
    df = spark.read.parquet(out)
    assert df.count() == 12
    assert "growth_rate_pct" in df.columns
