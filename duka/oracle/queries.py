"""DuckDB oracle SQL for every registered query.

These are written in the plain SQL shape of the analytics (fact joined to
dimensions, filters on dimension labels, COUNT(DISTINCT ...), NOT IN, self
joins, window functions), over the conformance CTEs of `conform.py`, so the
Spark plans (pre-aggregated, numbered without global windows, ...) are
checked against a straightforward formulation.
"""

from __future__ import annotations

from duka.functions import fixed
from duka.oracle.conform import pct_sql, ratio_sql, with_ctes
from duka.plans.builds import LINE_ORDER
from duka.plans.quality import KEY_CHECKS, NULL_CHECK_COLUMNS, ORPHAN_CHECKS

P = fixed.DEFAULTS


def T(x: str) -> str:
    return f"CAST(sum({x}) AS DECIMAL(38,2))"


def B(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ views
# an order has one date, so orders are counted as rows of their own sums
SQL["revenue_kpis"] = with_ctes(f"""
SELECT CAST(year(m) AS INTEGER) AS year, monthname(m) AS month_name, count(*) AS total_orders,
       {T('g')} AS gross_revenue_usd, {T('n')} AS net_revenue_usd, {T('p')} AS total_profit_usd,
       {pct_sql('sum(p)', 'sum(n)')} AS profit_margin_pct, {ratio_sql('sum(n)', 'count(*)')} AS aov_usd
FROM orders_kept GROUP BY m""", "sales_lines", extra={"orders_kept": f"""
SELECT date_trunc('month', any_value(order_date)) AS m, sum(gross_revenue_usd) AS g, sum(net_revenue_usd) AS n,
       sum(profit_usd) AS p
FROM sales_lines WHERE status_key <> ALL ({fixed.status_keys('Cancelled', 'Refunded')}) GROUP BY order_id"""})

SQL["customer_metrics"] = with_ctes(f"""
SELECT customer_segment, count(*) AS active_customers, {B('items')} AS total_items_purchased,
       {T('net')} AS total_revenue_usd, {ratio_sql('sum(net)', 'count(*)')} AS clv_usd
FROM customer_keys NATURAL JOIN buyers GROUP BY customer_segment""", "sales_lines", "customer_keys", extra={"buyers": f"""
SELECT customer_key, sum(quantity) AS items, sum(net_revenue_usd) AS net
FROM sales_lines WHERE status_key = {fixed.status_key('Completed')} GROUP BY customer_key"""})

# sums by (product, status), shared by the product reports
BY_STATUS = {"by_status": """
SELECT product_key, status_key, sum(quantity) AS q, sum(net_revenue_usd) AS net, sum(profit_usd) AS profit
FROM sales_lines GROUP BY product_key, status_key"""}
_returned_q = f"sum(q) FILTER (WHERE status_key = {fixed.status_key('Returned')})"
SQL["product_performance"] = with_ctes(f"""
SELECT category, sub_category, product_name, brand, {B('q')} AS units_sold, {T('net')} AS net_revenue_usd,
       {T('profit')} AS total_profit_usd, {pct_sql(f'coalesce({_returned_q}, 0)', 'sum(q)')} AS return_rate_pct
FROM dim_product NATURAL JOIN by_status
GROUP BY ALL""", "sales_lines", "dim_product", extra=BY_STATUS)

# a product's stock over the whole period in closed form: each day opens with the
# same stock, each first of a month adds a delivery, and a day's sales are taken off
STOCK = {"period": """
SELECT count(*) AS days, count(*) FILTER (WHERE day_number = 1) AS firsts FROM inventory_days""",
         "units": """
SELECT product_key, sum(quantity) AS sold FROM sales_lines SEMI JOIN inventory_days USING (date_key) GROUP BY product_key""",
         "stock": f"""
SELECT p.*, days, coalesce(sold, 0) AS sold, {fixed.OPENING_STOCK} * days AS opened,
       {fixed.OPENING_STOCK} * days + {fixed.RESTOCK_UNITS} * firsts - coalesce(sold, 0) AS closed
FROM dim_product p LEFT JOIN units u ON u.product_key = p.product_key CROSS JOIN period"""}
SQL["inventory_analytics"] = with_ctes(f"""
SELECT category, product_name, o AS total_opening_stock, u AS total_units_sold, c AS current_stock_on_hand,
       CAST(v AS DECIMAL(38,2)) AS inventory_value_usd,
       list_extract(['{fixed.STOCK_DEAD}', '{fixed.STOCK_OVER}', '{fixed.STOCK_OK}'],
                    CASE u WHEN 0 THEN 1 ELSE if(c - {fixed.OVERSTOCK_FACTOR} * u > 0, 2, 3) END) AS stock_health_status
FROM (SELECT category, product_name, {B('opened')} AS o, {B('sold')} AS u, {B('closed')} AS c,
             sum(closed * standard_cost) AS v
      FROM stock GROUP BY category, product_name)""", "inventory_days", "dim_product", "sales_lines", extra=STOCK)

SQL["marketing_roi_summary"] = with_ctes(f"""
SELECT campaign_name, channel, CAST(total.i AS BIGINT) AS total_impressions, CAST(total.c AS BIGINT) AS total_clicks,
       CAST(total.v AS BIGINT) AS total_conversions, CAST(total.k AS DECIMAL(38,2)) AS total_campaign_cost_usd,
       {ratio_sql('total.k', 'total.v')} AS cac_usd
FROM (SELECT campaign_key, {{'i': sum(impressions), 'c': sum(clicks), 'v': sum(conversions), 'k': sum(cost)}} AS total
      FROM fact_marketing GROUP BY campaign_key)
NATURAL JOIN (SELECT campaign_key, campaign_name, channel FROM dim_campaign)""", "fact_marketing", "dim_campaign")

# -------------------------------------------------------- customer versions
_tier = "CASE " + " ".join(f"WHEN count(*) >= {k} THEN '{label}'" for k, label in fixed.TIER_BY_ORDERS) \
    + f" ELSE '{fixed.TIER_DEFAULT}' END"
SCD2_CTES = {
    "obs": f"""
SELECT o_custkey AS customer_key, make_date(CAST(year(o_orderdate) AS BIGINT), 1, 1) AS obs_date,
       {_tier} AS customer_segment
FROM orders GROUP BY o_custkey, year(o_orderdate)""",
    "chg": """
SELECT *, lag(customer_segment) OVER (PARTITION BY customer_key ORDER BY obs_date) AS prev FROM obs""",
    "versions": f"""
SELECT customer_key, CAST(customer_key + 1 + {fixed.CUSTOMER_ID_BASE} AS BIGINT) AS customer_id,
       customer_key * 100000 + date_diff('day', DATE '1970-01-01', obs_date) AS customer_version_key,
       CAST(row_number() OVER w AS INTEGER) AS version, customer_segment, obs_date AS valid_from,
       CAST(lead(obs_date) OVER w - INTERVAL 1 DAY AS DATE) AS valid_to
FROM chg WHERE prev IS NULL OR prev <> customer_segment
WINDOW w AS (PARTITION BY customer_key ORDER BY obs_date)""",
}
# ------------------------------------------------------------- procedures
# the months of a year as one list in order; each is compared with the entry before it
SQL["monthly_revenue"] = with_ctes(f"""
SELECT monthname(make_date({P['target_year']}, cur.m, 1)) AS month_name, cur.n AS net_revenue_usd, cur.p AS total_profit_usd,
       CAST(cur.n - prev.n AS DECIMAL(38,2)) AS absolute_growth_usd, {pct_sql('cur.n - prev.n', 'prev.n')} AS growth_rate_pct
FROM (SELECT months[i] AS cur, CASE WHEN i > 1 THEN months[i - 1] END AS prev
      FROM (SELECT months, unnest(range(1, len(months) + 1)) AS i
            FROM (SELECT list({{'m': m, 'n': n, 'p': p}} ORDER BY m) AS months FROM by_month)))""",
                                 "sales_lines", extra={"by_month": f"""
SELECT month(order_date) AS m, {T('net_revenue_usd')} AS n, {T('profit_usd')} AS p
FROM sales_lines
WHERE date_key // 10000 = {P['target_year']} AND status_key <> ALL ({fixed.status_keys('Cancelled', 'Refunded')})
GROUP BY 1"""})

# lines of the current version: those from its first day on
SQL["customer_lifetime_value"] = with_ctes(f"""
SELECT customer_id, customer_name, customer_segment, country AS demography_country,
       len(list_distinct(list(order_id))) AS total_orders_placed, {B('quantity')} AS total_items_purchased,
       {T('net_revenue_usd')} AS historical_spend_usd, {T('profit_usd')} AS net_contribution_profit_usd
FROM (SELECT customer_key, customer_id, customer_name, customer_segment, country
      FROM customer_keys NATURAL JOIN (SELECT location_key, country FROM dim_location)
      WHERE customer_id = {P['customer_id']})
NATURAL JOIN (SELECT customer_key, order_id, order_date, quantity, net_revenue_usd, profit_usd FROM sales_lines)
NATURAL JOIN (SELECT customer_key, max(valid_from) AS since FROM versions GROUP BY customer_key)
WHERE order_date >= since
GROUP BY ALL""", "sales_lines", "customer_keys", "dim_location", extra=SCD2_CTES)

SQL["top_products"] = with_ctes(f"""
SELECT * FROM (
  SELECT product_name, category, brand, {B('q')} AS total_units_sold, {T('net')} AS generated_revenue_usd,
         {T('profit')} AS net_profit_usd
  FROM by_status NATURAL JOIN dim_product WHERE status_key = {fixed.status_key('Completed')}
  GROUP BY product_name, category, brand)
QUALIFY row_number() OVER (ORDER BY net_profit_usd DESC, product_name, category, brand) <= {P['top_n']}""",
                              "sales_lines", "dim_product", extra=BY_STATUS)

_oc = "sum((opened + closed) * standard_cost)"
_cogs = "sum(sold * standard_cost)"
SQL["inventory_turnover"] = with_ctes(f"""
SELECT category, sub_category, product_name, {B('sold')} AS total_units_sold,
       CAST({_cogs} AS DECIMAL(38,2)) AS cogs_usd,
       {ratio_sql(_oc, '2 * sum(days)')} AS average_inventory_value_usd,
       {ratio_sql(_cogs + ' * 2 * sum(days)', _oc)} AS inventory_turnover_ratio
FROM stock WHERE category = '{P['category']}'
GROUP BY ALL""", "inventory_days", "dim_product", "sales_lines", extra=STOCK)

# the sales of a campaign's day as a list; a campaign-day row repeats once per list
# entry, and once where there is none
SQL["campaign_roi"] = with_ctes(f"""
SELECT campaign_name, channel, {B('i')} AS impressions, {B('c')} AS clicks, {pct_sql('sum(c)', 'sum(i)', scale=3)} AS ctr_pct,
       {B('v')} AS conversions, {T('k')} AS total_campaign_cost_usd,
       CAST(coalesce(sum(net), 0) AS DECIMAL(38,2)) AS attribution_revenue_usd,
       {ratio_sql('coalesce(sum(net), 0) - sum(k)', 'sum(k)')} AS return_on_investment_ratio
FROM fanned NATURAL JOIN (SELECT campaign_key, campaign_name, channel FROM dim_campaign)
WHERE channel = '{P['channel']}' GROUP BY campaign_name, channel""",
                              "fact_marketing", "dim_campaign", "sales_lines", extra={
    "day_sales": "SELECT campaign_key, date_key, list(net_revenue_usd) AS nets FROM sales_lines GROUP BY ALL",
    "fanned": """
SELECT campaign_key, impressions AS i, clicks AS c, conversions AS v, cost AS k, unnest(coalesce(nets, [NULL])) AS net
FROM fact_marketing LEFT JOIN day_sales USING (campaign_key, date_key)"""})

SQL["campaign_roi_deduplicated"] = with_ctes(f"""
SELECT campaign_name, channel, {B('i')} AS impressions, {B('c')} AS clicks, {pct_sql('sum(c)', 'sum(i)', scale=3)} AS ctr_pct,
       {B('v')} AS conversions, {T('k')} AS total_campaign_cost_usd,
       CAST(coalesce(sum(net), 0) AS DECIMAL(38,2)) AS attribution_revenue_usd,
       {ratio_sql('coalesce(sum(net), 0) - sum(k)', 'sum(k)')} AS return_on_investment_ratio
FROM both_sides NATURAL JOIN (SELECT campaign_key, campaign_name, channel FROM dim_campaign)
WHERE channel = '{P['channel']}' GROUP BY campaign_name, channel""", "fact_marketing", "dim_campaign", "sales_lines", extra={
    "both_sides": """
SELECT campaign_key, impressions AS i, clicks AS c, conversions AS v, cost AS k, NULL AS net FROM fact_marketing
UNION ALL
SELECT campaign_key, NULL, NULL, NULL, NULL, net_revenue_usd
FROM sales_lines SEMI JOIN fact_marketing USING (campaign_key, date_key)"""})

# -------------------------------------------------------------- analytics
# periods of completed revenue, numbered; a period is compared with the one numbered before it
def _growth(period: str, label: str, name: str, extra_columns: str, rate: str) -> str:
    return with_ctes(f"""
SELECT CAST(year(a.period) AS INTEGER) AS year, {label}, a.revenue AS current_{name}_revenue_usd,
       CAST(coalesce(b.revenue, 0) AS DECIMAL(38,2)) AS previous_{name}_revenue_usd,{extra_columns}
       {pct_sql('a.revenue - b.revenue', 'b.revenue')} AS {rate}
FROM numbered a LEFT JOIN numbered b ON b.n = a.n - 1""", "sales_lines", extra={"numbered": f"""
SELECT date_trunc('{period}', order_date) AS period, {T('net_revenue_usd')} AS revenue,
       row_number() OVER (ORDER BY date_trunc('{period}', order_date)) AS n
FROM sales_lines WHERE status_key = {fixed.status_key('Completed')} GROUP BY 1"""})


SQL["mom_growth"] = _growth("month", "monthname(a.period) AS month_name", "month",
                            " CAST(a.revenue - b.revenue AS DECIMAL(38,2)) AS revenue_variance_usd,", "mom_growth_rate_pct")
SQL["qoq_growth"] = _growth("quarter", "concat('Q', quarter(a.period)) AS financial_quarter", "quarter", "",
                            "qoq_growth_rate_pct")

# a customer as one row: the first month and the list of months with a completed purchase
_after = "count(*) FILTER (WHERE list_contains(months, cohort_month + {k}))"
SQL["cohort_retention"] = with_ctes(f"""
SELECT printf('%d-%02d', (cohort_month // 12)::INTEGER, (cohort_month % 12 + 1)::INTEGER) AS cohort, count(*) AS cohort_size,
       {', '.join(f"{_after.format(k=k)} AS month_{k}_{'active' if k == 0 else 'retained'}" for k in range(4))},
       {pct_sql(_after.format(k=1), 'count(*)')} AS month_1_retention_rate_pct
FROM customers_by_month WHERE len(months) > 0 GROUP BY cohort_month""", "sales_lines", extra={"customers_by_month": f"""
SELECT min(m) AS cohort_month, coalesce(list(DISTINCT m) FILTER (WHERE status_key = {fixed.status_key('Completed')}), []) AS months
FROM (SELECT customer_key, status_key, 12 * year(order_date) + month(order_date) - 1 AS m FROM sales_lines)
GROUP BY customer_key"""})

# quartiles from row numbers: the first n % 4 tiles hold one row more; a segment is the
# first row of the rule table whose ranges hold the three tiles
def _tile(order: str) -> str:
    rn = f"row_number() OVER (ORDER BY {order}, customer_key)"
    n = "count(*) OVER ()"
    return (f"CASE WHEN {rn} <= {n} % 4 * ({n} // 4 + 1) THEN ({rn} - 1) // ({n} // 4 + 1) + 1 "
            f"ELSE {n} % 4 + ({rn} - {n} % 4 * ({n} // 4 + 1) - 1) // greatest({n} // 4, 1) + 1 END")


_rules = ", ".join(f"({k}, '{label}', {r0}, {r1}, {f0}, {f1}, {m0})" for k, (label, r0, r1, f0, f1, m0) in enumerate([
    (fixed.RFM_CHAMPIONS, 3, 4, 3, 4, 3), (fixed.RFM_AT_RISK, 1, 2, 3, 4, 1),
    (fixed.RFM_PROMISING, 3, 4, 1, 1, 1), (fixed.RFM_HIBERNATING, 1, 4, 1, 4, 1)]))
SQL["rfm_segments"] = with_ctes(f"""
SELECT customer_id, customer_name, recency_days, order_frequency, total_monetary_value_usd,
       arg_min(label, priority) AS actionable_marketing_segment
FROM tiles NATURAL JOIN (SELECT customer_key, customer_id, customer_name FROM customer_keys)
JOIN (VALUES {_rules}) rules(priority, label, r0, r1, f0, f1, m0)
  ON r BETWEEN r0 AND r1 AND f BETWEEN f0 AND f1 AND m >= m0
GROUP BY ALL""", "sales_lines", "customer_keys", extra={
    "habits": f"""
SELECT customer_key, CAST(DATE '{P['rfm_as_of']}' - max(d) AS INTEGER) AS recency_days, count(*) AS order_frequency,
       {T('net')} AS total_monetary_value_usd
FROM (SELECT customer_key, order_id, max(order_date) AS d, sum(net_revenue_usd) AS net FROM sales_lines
      WHERE status_key = {fixed.status_key('Completed')} GROUP BY customer_key, order_id)
GROUP BY customer_key""",
    "tiles": f"""
SELECT *, {_tile('recency_days DESC')} AS r, {_tile('order_frequency')} AS f, {_tile('total_monetary_value_usd')} AS m
FROM habits"""})

SQL["dead_stock"] = with_ctes(f"""
SELECT product_id, product_name, category, brand, {B('closed')} AS unsold_units_on_hand,
       CAST(sum(closed * standard_cost) AS DECIMAL(38,2)) AS tied_up_capital_usd
FROM stock JOIN (
  SELECT product_key FROM dim_product
  EXCEPT SELECT product_key FROM sales_lines WHERE date_key >= {P['dead_stock_cutoff_key']}) USING (product_key)
GROUP BY ALL HAVING sum(closed) > 0""", "inventory_days", "dim_product", "sales_lines", extra=STOCK)

SQL["returned_products"] = with_ctes(f"""
SELECT product_name, category, CAST(kept AS BIGINT) AS total_units_kept, CAST(back AS BIGINT) AS total_units_returned,
       {pct_sql('back', 'units')} AS return_rate_pct, CAST(lost AS DECIMAL(38,2)) AS lost_revenue_usd
FROM (SELECT product_name, category, sum(q) AS units, {_returned_q} AS back,
             coalesce(sum(q) FILTER (WHERE status_key = {fixed.status_key('Completed')}), 0) AS kept,
             sum(net) FILTER (WHERE status_key = {fixed.status_key('Returned')}) AS lost
      FROM by_status NATURAL JOIN dim_product GROUP BY product_name, category)
WHERE back > 0""", "sales_lines", "dim_product", extra=BY_STATUS)

# a basket as a sorted list of its products and their line counts; each product is
# paired with the rest of the list, weighted by both counts
def _baskets(where: str) -> dict[str, str]:
    return {"baskets": f"""
SELECT list({{'k': product_key, 'n': n}} ORDER BY product_key) AS items
FROM (SELECT order_id, product_key, count(*) AS n FROM sales_lines WHERE product_key IS NOT NULL AND {where} GROUP BY ALL)
GROUP BY order_id HAVING count(*) > 1""",
            "pairs": """
SELECT a.k AS product_a, b.k AS product_b, CAST(sum(a.n * b.n) AS BIGINT) AS times
FROM (SELECT items[i] AS a, unnest(items[i + 1:]) AS b
      FROM (SELECT items, unnest(range(1, len(items))) AS i FROM baskets))
GROUP BY 1, 2"""}


SQL["market_basket"] = with_ctes(f"""
SELECT a.category AS product_a_category, a.product_name AS product_a_name, b.category AS product_b_category,
       b.product_name AS product_b_name, {B('times')} AS times_purchased_together
FROM dim_product a, pairs, dim_product b
WHERE a.product_key = product_a AND b.product_key = product_b
GROUP BY ALL HAVING sum(times) > {P['basket_min_pairs']}""", "sales_lines", "dim_product",
                               extra=_baskets(f"status_key = {fixed.status_key('Completed')}"))

SQL["market_basket_keys"] = with_ctes(
    "SELECT product_a, product_b, times AS times_purchased_together FROM pairs", "sales_lines", extra=_baskets("TRUE"))

# --------------------------------------------------------------- measures
SQL["fiscal_ytd_sales"] = with_ctes("""
SELECT fiscal_year, fiscal_month, sales_usd,
       CAST(sum(sales_usd) OVER (PARTITION BY fiscal_year ORDER BY fiscal_month
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS fiscal_ytd_sales_usd
FROM fm""", "sales_lines", "dim_date", extra={"fm": f"""
SELECT d.fiscal_year, d.fiscal_month, {T('fs.net_revenue_usd')} AS sales_usd
FROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key
GROUP BY d.fiscal_year, d.fiscal_month"""})

SQL["ending_inventory"] = with_ctes("""
SELECT year, month_number, category, CAST(arg_max(stock, date_key) AS BIGINT) AS ending_stock
FROM daily GROUP BY year, month_number, category""", "fact_inventory", "dim_product", "dim_date",
                                    extra={"daily": """
SELECT d.year, d.month_number, p.category, fi.date_key, sum(fi.closing_stock) AS stock
FROM fact_inventory fi JOIN dim_product p ON fi.product_key = p.product_key
JOIN dim_date d ON fi.date_key = d.date_key
GROUP BY d.year, d.month_number, p.category, fi.date_key"""})

SQL["inventory_turnover_ratio"] = with_ctes(f"""
SELECT category, total_cogs_usd, {ratio_sql('v', 'n')} AS avg_inventory_value_usd,
       {ratio_sql('total_cogs_usd * n', 'v', zero=0)} AS inventory_turnover_ratio
FROM (SELECT category, sum(closed * standard_cost) AS v, sum(days) AS n FROM stock GROUP BY category)
LEFT JOIN (SELECT category, {T('cost_usd')} AS total_cogs_usd FROM sales_lines JOIN dim_product USING (product_key)
           GROUP BY category) USING (category)""", "inventory_days", "dim_product", "sales_lines", extra=STOCK)

SQL["net_revenue_ex_tax"] = with_ctes(f"""
SELECT country, {T('g')} AS gross_revenue_usd,
       CAST(sum({ratio_sql('g', '1 + vat_rate')}) AS DECIMAL(38,2)) AS net_revenue_ex_tax_usd
FROM by_rate GROUP BY country""", "sales_lines", "location_market", extra={"by_rate": """
SELECT lm.country, lm.vat_rate, sum(fs.gross_revenue_usd) AS g
FROM sales_lines fs LEFT JOIN location_market lm ON fs.location_key = lm.location_key
GROUP BY lm.country, lm.vat_rate"""})

SQL["returns_liability"] = with_ctes(f"""
SELECT year, quarter, returned_usd, settled_usd,
       CAST(CASE WHEN returned_usd IS NULL THEN NULL
                 ELSE {ratio_sql('returned_usd', 'settled_usd', scale=4, zero=0)} END
            AS DECIMAL(38,4)) AS active_revenue_risk
FROM q""", "sales_lines", "dim_date", "dim_status", extra={"q": """
SELECT d.year, d.quarter,
       CAST(sum(CASE WHEN s.status_name = 'Returned' THEN fs.net_revenue_usd END) AS DECIMAL(38,2)) AS returned_usd,
       CAST(sum(CASE WHEN s.status_name = 'Completed' THEN fs.net_revenue_usd END) AS DECIMAL(38,2)) AS settled_usd
FROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key
JOIN dim_status s ON fs.status_key = s.status_key
GROUP BY d.year, d.quarter"""})

SQL["rolling_12m_ltv"] = with_ctes(f"""
SELECT year, month_number, trail AS trailing_12m_revenue_usd, active_customers,
       {ratio_sql('trail', 'active_customers')} AS rolling_12m_ltv_usd
FROM (SELECT *, CAST(sum(rev) OVER (ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
                     AS DECIMAL(38,2)) AS trail FROM m)""", "sales_lines", "dim_date", extra={"m": """
SELECT d.year, d.month_number, sum(fs.net_revenue_usd) AS rev,
       count(DISTINCT fs.customer_key) AS active_customers, d.year * 12 + d.month_number - 1 AS mi
FROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key
GROUP BY d.year, d.month_number"""})

# ----------------------------------------------------------------- builds
SQL["dim_date"] = with_ctes("SELECT * FROM dim_date", "dim_date")
SQL["fiscal_calendar"] = with_ctes(
    "SELECT date_key, fiscal_month, fiscal_quarter, fiscal_year FROM dim_date", "dim_date")
SQL["localize_sales"] = with_ctes("""
SELECT order_id, line_number, product_key, country, local_currency, exchange_rate_to_usd,
       unit_price_local, discount_amount_local, tax_amount_local, product_cost_local
FROM sales_lines""", "sales_lines")
SQL["sales_usd_measures"] = with_ctes("""
SELECT order_id, line_number, product_key, gross_revenue_usd, net_revenue_usd, tax_usd, profit_usd
FROM sales_lines""", "sales_lines")
SQL["sales_local_measures"] = with_ctes("""
SELECT order_id, line_number, product_key, line_amount_local AS gross_revenue_local,
       CAST(line_amount_local - discount_amount_local AS DECIMAL(18,2)) AS net_revenue_local,
       CAST(CAST(line_amount_local - discount_amount_local AS DECIMAL(18,2)) - line_cost_local
            AS DECIMAL(18,2)) AS profit_local
FROM sales_lines""", "sales_lines")

_line_order = ", ".join(LINE_ORDER)
SQL["fact_sales"] = with_ctes(f"""
SELECT row_number() OVER (ORDER BY order_id, {_line_order}) AS sales_fact_key, order_id,
       CAST(row_number() OVER (PARTITION BY order_id ORDER BY {_line_order}) AS INTEGER) AS order_line_number,
       date_key, sales_lines.customer_key, customer_version_key, product_key, location_key, campaign_key, status_key, order_source,
       quantity, local_currency, exchange_rate_to_usd, unit_price_local, discount_amount_local,
       tax_amount_local, product_cost_local, gross_revenue_usd, net_revenue_usd, tax_usd, profit_usd
FROM sales_lines ASOF LEFT JOIN (SELECT customer_key, valid_from, customer_version_key FROM versions) v
  ON sales_lines.customer_key = v.customer_key AND sales_lines.order_date >= v.valid_from""", "sales_lines", extra=SCD2_CTES)
SQL["fact_inventory"] = with_ctes("SELECT * FROM fact_inventory", "fact_inventory")
SQL["campaign_cost_daily"] = with_ctes("SELECT * FROM campaign_days", "campaign_days")
SQL["fact_marketing"] = with_ctes("SELECT * FROM fact_marketing", "fact_marketing")
SQL["fact_marketing_incremental"] = SQL["fact_marketing"]
SQL["customer_attributes"] = with_ctes(
    "SELECT customer_key, customer_id, gender, age_group, customer_segment FROM customer_keys",
    "customer_keys")
SQL["assign_campaign"] = with_ctes(f"""
SELECT o.o_orderkey AS order_id, c.campaign_key, c.campaign_name
FROM orders o JOIN dim_campaign c ON CAST(o.o_orderkey % {len(fixed.CAMPAIGNS)} + 1 AS INTEGER) = c.campaign_key""",
                                   "dim_campaign")

SQL["scd2_build"] = with_ctes("""
SELECT customer_key, customer_id, customer_version_key, version, customer_segment, valid_from, valid_to,
       valid_to IS NULL AS is_current FROM versions""", extra=SCD2_CTES)
SQL["scd2_incremental"] = SQL["scd2_build"]
SQL["scd2_current"] = with_ctes("""
SELECT customer_key, customer_id, customer_segment, valid_from FROM versions WHERE valid_to IS NULL""",
                                extra=SCD2_CTES)
SQL["scd2_point_in_time"] = with_ctes("""
SELECT CAST(year(fs.order_date) AS INTEGER) AS year, v.customer_segment, count(*) AS lines,
       CAST(sum(fs.quantity) AS BIGINT) AS units
FROM sales_lines fs JOIN versions v ON fs.customer_key = v.customer_key
 AND fs.order_date BETWEEN v.valid_from AND coalesce(v.valid_to, DATE '9999-12-31')
GROUP BY 1, 2""", "sales_lines", extra=SCD2_CTES)

_counted = ["dim_date", "dim_location", "dim_customer", "dim_product", "dim_campaign", "dim_status", "versions",
            "sales_lines", "fact_marketing", "campaign_days", "fact_inventory"]
SQL["star_row_counts"] = with_ctes(" UNION ALL ".join(
    [f"SELECT '{'customer_versions' if t == 'versions' else t}' AS table_name, count(*) AS row_count FROM {t}" for t in _counted]
    + [f"""SELECT 'revenue_kpis', count(DISTINCT date_trunc('month', order_date)) FROM sales_lines
           WHERE status_key <> ALL ({fixed.status_keys('Cancelled', 'Refunded')})"""]),
    *[t for t in _counted if t != "versions"], extra=SCD2_CTES)

# ---------------------------------------------------------------- quality
_TABLE_SQL = {"w:sales_lines": "sales_lines", "w:dim_date": "dim_date",
              "w:dim_status": "dim_status", "w:dim_campaign": "dim_campaign",
              "w:fact_marketing": "fact_marketing"}


def _t(name: str) -> str:
    return _TABLE_SQL.get(name, name)


SQL["dq_orphans"] = with_ctes("\nUNION ALL\n".join(f"""
SELECT '{check}' AS check_name, count(*) AS child_rows, count(*) FILTER (WHERE p.k IS NULL) AS orphan_rows
FROM {_t(child)} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {_t(parent)}) p ON c.{ck} = p.k"""
                                                   for check, child, ck, parent, pk in ORPHAN_CHECKS),
                              "sales_lines", "dim_date", "dim_status", "dim_campaign", "fact_marketing",
                              "market_policy")

SQL["dq_duplicate_keys"] = with_ctes("\nUNION ALL\n".join(f"""
SELECT '{check}' AS check_name, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicated_keys,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicates
FROM (SELECT {', '.join(keys)}, count(*) AS n FROM {_t(table)} GROUP BY {', '.join(keys)})"""
                                                         for check, table, keys in KEY_CHECKS),
                                     "dim_date", "fact_marketing")

SQL["dq_null_counts"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM {'sales_lines' if t == 'fact_sales' else t}"
    for t, cols in NULL_CHECK_COLUMNS.items() for c in cols), "sales_lines", "dim_customer")

# ------------------------------------------------------------- constructs
SQL["src_status_values"] = with_ctes("""
SELECT s.status_key, s.status_name, coalesce(c.n, 0) AS line_count
FROM dim_status s LEFT JOIN (SELECT status_key, count(*) AS n FROM sales_lines GROUP BY 1) c
  ON s.status_key = c.status_key""", "dim_status", "sales_lines")

SQL["filter_status_not_in"] = with_ctes(f"""
SELECT count(*) AS line_count, {T('fs.net_revenue_usd')} AS net_revenue_usd
FROM sales_lines fs JOIN dim_status s ON fs.status_key = s.status_key
WHERE s.status_name NOT IN ('Cancelled', 'Refunded')""", "sales_lines", "dim_status")

SQL["filter_modulo"] = with_ctes("""
SELECT d.year, count(*) AS line_count
FROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key
WHERE d.day_number % 4 = 0 AND d.year BETWEEN 1996 AND 2000
GROUP BY d.year""", "sales_lines", "dim_date")

SQL["join_star"] = with_ctes(f"""
SELECT p.category, d.year, count(*) AS line_count, {B('fs.quantity')} AS units
FROM sales_lines fs JOIN dim_product p ON fs.product_key = p.product_key
JOIN dim_date d ON fs.date_key = d.date_key
GROUP BY p.category, d.year""", "sales_lines", "dim_product", "dim_date")

SQL["join_snowflake"] = with_ctes(f"""
SELECT loc.country, count(*) AS line_count, {B('fs.quantity')} AS units
FROM sales_lines fs JOIN customer_keys c ON fs.customer_key = c.customer_key
JOIN dim_location loc ON c.location_key = loc.location_key
GROUP BY loc.country""", "sales_lines", "customer_keys", "dim_location")

SQL["join_left_multi"] = with_ctes("""
SELECT fm.campaign_key, count(*) AS campaign_days, count(sd.lines) AS matched_days,
       count(*) FILTER (WHERE sd.lines IS NULL) AS unmatched_days,
       CAST(coalesce(sum(sd.lines), 0) AS BIGINT) AS matched_lines
FROM fact_marketing fm
LEFT JOIN (SELECT campaign_key, date_key, count(*) AS lines FROM sales_lines GROUP BY 1, 2) sd
  ON fm.campaign_key = sd.campaign_key AND fm.date_key = sd.date_key
GROUP BY fm.campaign_key""", "fact_marketing", "sales_lines")

SQL["join_cross_dense"] = with_ctes("""
SELECT d.year, d.month_number, count(*) AS grid_cells,
       count(*) FILTER (WHERE coalesce(s.sold, 0) = 0) AS zero_cells,
       CAST(sum(coalesce(s.sold, 0)) AS BIGINT) AS units
FROM dim_date d CROSS JOIN dim_product p
LEFT JOIN (SELECT date_key, product_key, sum(quantity) AS sold FROM sales_lines GROUP BY 1, 2) s
  ON s.date_key = d.date_key AND s.product_key = p.product_key
GROUP BY d.year, d.month_number""", "dim_date", "dim_product", "sales_lines")

SQL["join_self_theta"] = with_ctes("""
SELECT a.order_id, count(*) AS pair_count
FROM sales_lines a JOIN sales_lines b ON a.order_id = b.order_id AND a.product_key < b.product_key
GROUP BY a.order_id""", "sales_lines")

SQL["join_range_dates"] = with_ctes("""
SELECT d.date_key, count(*) AS active_campaigns
FROM dim_date d JOIN dim_campaign c ON d.full_date BETWEEN c.start_date AND c.end_date
GROUP BY d.date_key""", "dim_date", "dim_campaign")

SQL["anti_join_not_in"] = with_ctes(f"""
SELECT p.product_key, p.product_name FROM dim_product p
WHERE p.product_key NOT IN (SELECT product_key FROM sales_lines WHERE date_key >= {P['dead_stock_cutoff_key']})""",
                                    "dim_product", "sales_lines")

SQL["anti_join_left_anti"] = with_ctes(f"""
SELECT p.product_key, p.product_name FROM dim_product p
WHERE NOT EXISTS (SELECT 1 FROM sales_lines s
                  WHERE s.product_key = p.product_key AND s.date_key >= {P['dead_stock_cutoff_key']})""",
                                       "dim_product", "sales_lines")

SQL["agg_count_distinct"] = with_ctes("""
SELECT c.customer_segment, count(DISTINCT fs.customer_key) AS distinct_customers,
       count(DISTINCT fs.order_id) AS distinct_orders
FROM sales_lines fs JOIN customer_keys c ON fs.customer_key = c.customer_key
GROUP BY c.customer_segment""", "sales_lines", "customer_keys")

SQL["agg_conditional_sum"] = with_ctes(f"""
SELECT p.category,
       CAST(sum(CASE WHEN fs.status_key = 2 THEN fs.quantity ELSE 0 END) AS BIGINT) AS returned_units,
       {T('CASE WHEN fs.status_key = 1 THEN fs.net_revenue_usd ELSE 0 END')} AS completed_net_usd
FROM sales_lines fs JOIN dim_product p ON fs.product_key = p.product_key
GROUP BY p.category""", "sales_lines", "dim_product")

SQL["agg_min_max_date"] = with_ctes("""
SELECT c.customer_segment, min(fs.order_date) AS first_order_date, max(fs.order_date) AS last_order_date
FROM sales_lines fs JOIN customer_keys c ON fs.customer_key = c.customer_key
GROUP BY c.customer_segment""", "sales_lines", "customer_keys")

SQL["agg_avg_expression"] = with_ctes(f"""
SELECT p.category, {ratio_sql('sum(fs.net_revenue_usd)', 'count(*)')} AS avg_net_revenue_usd
FROM sales_lines fs JOIN dim_product p ON fs.product_key = p.product_key
GROUP BY p.category""", "sales_lines", "dim_product")

SQL["agg_having"] = with_ctes(f"""
SELECT p.category, p.brand, count(*) AS line_count, {T('fs.net_revenue_usd')} AS net_revenue_usd
FROM sales_lines fs JOIN dim_product p ON fs.product_key = p.product_key
GROUP BY p.category, p.brand
HAVING count(*) > 300""", "sales_lines", "dim_product")

SQL["agg_pivot_months"] = with_ctes(",\n".join(
    ["SELECT d.year"] + [f"       CAST(sum(CASE WHEN d.quarter = {q} THEN fs.quantity END) AS BIGINT) AS q{q}_units"
                         for q in (1, 2, 3, 4)])
    + "\nFROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key GROUP BY d.year",
    "sales_lines", "dim_date")

SQL["window_lag"] = with_ctes("""
SELECT *, lag(units) OVER (ORDER BY year, month_number) AS previous_units FROM m""",
                              "sales_lines", "dim_date", extra={"m": f"""
SELECT d.year, d.month_number, {B('fs.quantity')} AS units
FROM sales_lines fs JOIN dim_date d ON fs.date_key = d.date_key GROUP BY d.year, d.month_number"""})

SQL["window_ntile"] = with_ctes("""
SELECT customer_key, order_count,
       CAST(ntile(4) OVER (ORDER BY order_count, customer_key) AS INTEGER) AS quartile
FROM (SELECT customer_key, count(DISTINCT order_id) AS order_count FROM sales_lines GROUP BY 1)""",
                                "sales_lines")

SQL["order_line_number"] = with_ctes(f"""
SELECT order_id, line_number, product_key, quantity,
       CAST(row_number() OVER (PARTITION BY order_id ORDER BY {_line_order}) AS INTEGER) AS order_line_number
FROM sales_lines""", "sales_lines")

SQL["surrogate_keys"] = with_ctes("""
SELECT product_key, brand, product_name,
       row_number() OVER (ORDER BY brand, product_name, product_key) AS surrogate_key
FROM dim_product""", "dim_product")

SQL["surrogate_keys_reload"] = with_ctes("""
SELECT product_key, product_name, row_number() OVER (ORDER BY product_key NOT IN (
           SELECT product_key FROM sales_lines, date_bounds WHERE product_key IS NOT NULL AND year(order_date) = year(lo)),
           product_key) AS surrogate_key
FROM dim_product""", "dim_product", "sales_lines", "date_bounds")

SQL["sample_n"] = with_ctes(f"""
SELECT order_id, line_number, product_key, l_suppkey, quantity,
       md5(concat_ws('|', '{P['sample_seed']}', order_id, line_number, product_key, l_suppkey)) AS sample_hash
FROM sales_lines
ORDER BY sample_hash, order_id, line_number, product_key, l_suppkey, quantity
LIMIT {P['sample_n']}""", "sales_lines")

SQL["date_functions"] = with_ctes(f"""
SELECT x AS order_date, CAST(year(x) * 10000 + month(x) * 100 + day(x) AS INTEGER) AS date_key,
       CAST(day(x) AS INTEGER) AS day_number, CAST(month(x) AS INTEGER) AS month_number,
       CAST(quarter(x) AS INTEGER) AS quarter, CAST(year(x) AS INTEGER) AS year,
       CAST(floor((dayofyear(x) + dayofweek(date_trunc('year', x)) + 1 - 2) / 7) + 1 AS INTEGER) AS week_number,
       dayofweek(x) IN (0, 6) AS is_weekend, dayname(x) AS day_name, monthname(x) AS month_name,
       x + 7 AS plus_7_days, CAST(date_trunc('month', x) AS DATE) AS month_start,
       CAST(date_diff('month', DATE '{fixed.SIGNUP_FALLBACK}', x) AS INTEGER) AS months_since_base,
       CAST(date_diff('day', DATE '{fixed.SIGNUP_FALLBACK}', x) AS INTEGER) AS days_since_base,
       strftime(x, '%Y-%m') AS year_month
FROM (SELECT DISTINCT order_date AS x FROM sales_lines)""", "sales_lines")

_margin = "CAST(selling_price - standard_cost AS DECIMAL(18,2))"
SQL["math_null_functions"] = with_ctes(f"""
SELECT product_key,
       CAST(round(selling_price * CAST(0.16 AS DECIMAL(2,2)), 2) AS DECIMAL(18,2)) AS vat_16_rounded,
       abs(CAST(standard_cost - selling_price AS DECIMAL(18,2))) AS abs_margin,
       product_key % 7 AS key_mod_7,
       nullif(product_key % 3, 0) AS nullif_mod_3,
       coalesce(nullif(product_key % 3, 0), -1) AS coalesce_mod_3,
       CAST(product_key % 100 AS DECIMAL(18,2)) AS key_as_decimal,
       {ratio_sql(_margin, 'product_key % 5', zero=0)} AS divide_or_zero,
       {ratio_sql(_margin, 'product_key % 5')} AS divide_or_null
FROM dim_product""", "dim_product")

SQL["string_functions"] = with_ctes(f"""
SELECT customer_key, '{fixed.GENERATED_NAME}' || CAST(customer_key + 1 AS VARCHAR) AS generated_name,
       strftime(signup_date, '%Y-%m') AS signup_month,
       'Q' || CAST(quarter(signup_date) AS VARCHAR) AS signup_quarter,
       upper(customer_segment) AS segment_upper
FROM dim_customer""", "dim_customer")


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
