"""Rows come out in the order the reports state (the value comparison ignores order)."""

import pytest

from duka.plans import registry
from tests.conftest import SF_SMALL

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]


def _down(*names):
    """Descending by the columns, NULL last."""
    return lambda r: tuple((r[n] is None, 0 if r[n] is None else -r[n]) for n in names)


ORDERS = {
    "monthly_revenue": lambda r: MONTHS.index(r["month_name"]),
    "mom_growth": lambda r: (r["year"], MONTHS.index(r["month_name"])),
    "qoq_growth": lambda r: (r["year"], r["financial_quarter"]),
    "cohort_retention": lambda r: r["cohort"],
    "rfm_segments": _down("total_monetary_value_usd"),
    "dead_stock": _down("tied_up_capital_usd"),
    "returned_products": _down("return_rate_pct", "lost_revenue_usd"),
    "market_basket": _down("times_purchased_together"),
    "top_products": _down("net_profit_usd"),
    "inventory_turnover": _down("inventory_turnover_ratio"),
    "campaign_roi": _down("return_on_investment_ratio"),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_in_order(spark, name):
    rows = registry.run(name, spark, SF_SMALL if name != "market_basket" else "/root/testdata/sf0.01").collect()
    assert rows and rows == sorted(rows, key=ORDERS[name])
