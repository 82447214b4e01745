"""Query registry: name -> function(Warehouse) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duka.plans import analytics, builds, measures, primitives, procedures, quality, stored, views
from duka.session import apply_defaults
from duka.sources.warehouse import Warehouse
from duka.streaming.marketing import fact_marketing_incremental

PLANS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # reporting views
    "revenue_kpis": views.revenue_kpis,
    "customer_metrics": views.customer_metrics,
    "product_performance": views.product_performance,
    "inventory_analytics": views.inventory_analytics,
    "marketing_roi_summary": views.marketing_roi_summary,
    # parameterised reports
    "monthly_revenue": procedures.monthly_revenue,
    "customer_lifetime_value": procedures.customer_lifetime_value,
    "top_products": procedures.top_products,
    "inventory_turnover": procedures.inventory_turnover,
    "campaign_roi": procedures.campaign_roi,
    "campaign_roi_deduplicated": procedures.campaign_roi_deduplicated,
    # analytics
    "mom_growth": analytics.mom_growth,
    "qoq_growth": analytics.qoq_growth,
    "cohort_retention": analytics.cohort_retention,
    "rfm_segments": analytics.rfm_segments,
    "dead_stock": analytics.dead_stock,
    "returned_products": analytics.returned_products,
    "market_basket": analytics.market_basket,
    "market_basket_keys": analytics.market_basket_keys,
    # measures
    "fiscal_ytd_sales": measures.fiscal_ytd_sales,
    "ending_inventory": measures.ending_inventory,
    "inventory_turnover_ratio": measures.inventory_turnover_ratio,
    "net_revenue_ex_tax": measures.net_revenue_ex_tax,
    "returns_liability": measures.returns_liability,
    "rolling_12m_ltv": measures.rolling_12m_ltv,
    # build jobs
    "dim_date": builds.dim_date,
    "fiscal_calendar": builds.fiscal_calendar,
    "localize_sales": builds.localize_sales,
    "sales_usd_measures": builds.sales_usd_measures,
    "sales_local_measures": builds.sales_local_measures,
    "fact_sales": builds.fact_sales,
    "fact_inventory": builds.fact_inventory,
    "campaign_cost_daily": builds.campaign_cost_daily,
    "fact_marketing": builds.fact_marketing,
    "fact_marketing_incremental": fact_marketing_incremental,
    "customer_attributes": builds.customer_attributes,
    "assign_campaign": builds.assign_campaign,
    "scd2_build": builds.scd2_build,
    "scd2_incremental": builds.scd2_incremental,
    "scd2_current": builds.scd2_current,
    "scd2_point_in_time": builds.scd2_point_in_time,
    "star_row_counts": stored.star_row_counts,
    # data quality
    "dq_orphans": quality.dq_orphans,
    "dq_duplicate_keys": quality.dq_duplicate_keys,
    "dq_null_counts": quality.dq_null_counts,
    # constructs
    "src_status_values": primitives.src_status_values,
    "filter_status_not_in": primitives.filter_status_not_in,
    "filter_modulo": primitives.filter_modulo,
    "join_star": primitives.join_star,
    "join_snowflake": primitives.join_snowflake,
    "join_left_multi": primitives.join_left_multi,
    "join_cross_dense": primitives.join_cross_dense,
    "join_self_theta": primitives.join_self_theta,
    "join_range_dates": primitives.join_range_dates,
    "anti_join_not_in": primitives.anti_join_not_in,
    "anti_join_left_anti": primitives.anti_join_left_anti,
    "agg_count_distinct": primitives.agg_count_distinct,
    "agg_conditional_sum": primitives.agg_conditional_sum,
    "agg_min_max_date": primitives.agg_min_max_date,
    "agg_avg_expression": primitives.agg_avg_expression,
    "agg_having": primitives.agg_having,
    "agg_pivot_months": primitives.agg_pivot_months,
    "window_lag": primitives.window_lag,
    "window_ntile": primitives.window_ntile,
    "order_line_number": primitives.order_line_number,
    "surrogate_keys": primitives.surrogate_keys,
    "surrogate_keys_reload": primitives.surrogate_keys_reload,
    "sample_n": primitives.sample_n,
    "date_functions": primitives.date_functions,
    "math_null_functions": primitives.math_null_functions,
    "string_functions": primitives.string_functions,
}


def warehouse(spark: SparkSession, sf_dir: str, store_dir: str | None = None,
              **params) -> Warehouse:
    """The star derived from the raw tables, or read from a built store."""
    if store_dir:
        from duka.sources.store import StoredWarehouse
        return StoredWarehouse(spark, store_dir, sf_dir, **params)
    return Warehouse(spark, sf_dir, **params)


def run(name: str, spark: SparkSession, sf_dir: str, store_dir: str | None = None,
        **params) -> DataFrame:
    return PLANS[name](warehouse(spark, sf_dir, store_dir, **params))


def as_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Warehouse(apply_defaults(spark), sf_dir))
    return {name: bind(fn) for name, fn in PLANS.items()}
