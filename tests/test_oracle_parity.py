"""Every registered query equals its DuckDB oracle on the driver tables."""

import pytest

import __spark_entry__ as E
from duka.oracle.compare import _rows, duck
from duka.plans import registry
from tests.conftest import SF_SMALL

NAMES = sorted(registry.PLANS)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, rows) == _rows(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month_name", "current_month_revenue_usd",
                          "previous_month_revenue_usd", "revenue_variance_usd",
                          "mom_growth_rate_pct"]
