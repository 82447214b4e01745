"""duka: retail star-schema warehouse analytics on Spark DataFrames.

Build jobs derive calendar, customer (with SCD2 history), product, sales,
inventory-snapshot and campaign-day tables from raw order data; query plans
compute revenue KPIs, growth, cohorts, RFM, dead stock, returns, market
baskets, campaign ROI, inventory turnover and fiscal-calendar measures.
"""

from duka.session import get_session  # noqa: F401
from duka.sources.warehouse import Warehouse  # noqa: F401

__all__ = ["get_session", "Warehouse"]
