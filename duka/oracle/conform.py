"""The warehouse conformance as DuckDB CTE text (the oracle side).

Each CTE mirrors a `Warehouse` attribute; `with_ctes(body, ...)` prefixes a
query with the CTEs it needs (dependencies resolved). Decimal ratios use
integer arithmetic because DuckDB divides decimals in DOUBLE.
"""

from __future__ import annotations

from duka.functions import fixed


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def date_key_sql(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def week_sql(d: str) -> str:
    # DuckDB dayofweek: Sunday = 0
    return (f"CAST(floor((dayofyear({d}) + dayofweek(date_trunc('year', {d})) + 1 - 2) / 7) + 1 "
            f"AS INTEGER)")


def fiscal_month_sql(d: str) -> str:
    s = fixed.FISCAL_START_MONTH
    return (f"CAST(CASE WHEN month({d}) >= {s} THEN month({d}) - {s - 1} "
            f"ELSE month({d}) + {13 - s} END AS INTEGER)")


def fiscal_year_sql(d: str) -> str:
    s = fixed.FISCAL_START_MONTH
    return f"CAST(CASE WHEN month({d}) >= {s} THEN year({d}) ELSE year({d}) - 1 END AS INTEGER)"


def size_band_sql(col: str) -> str:
    parts = [f"WHEN {col} <= {u} THEN '{label}'" for u, label in fixed.SIZE_BANDS[:-1]]
    return f"CASE {' '.join(parts)} ELSE '{fixed.SIZE_BANDS[-1][1]}' END"


def segment_sql(n: str) -> str:
    parts = [f"WHEN {n} % {k} = 0 THEN '{label}'" for k, label in fixed.SEGMENT_RULES]
    return f"CASE {' '.join(parts)} ELSE '{fixed.SEGMENT_DEFAULT}' END"


def age_sql(n: str) -> str:
    parts = [f"WHEN {n} % 4 = {i} THEN '{a}'" for i, a in enumerate(fixed.AGE_GROUPS)]
    return f"CASE {' '.join(parts)} END"


def ratio_sql(num: str, den: str, scale: int = 2, times: int = 1, zero=None) -> str:
    """round(num/den*times, scale) exactly, half away from zero; NULL on 0.

    num and den are decimals with at most 2 decimals (or integers); they are
    turned into integer cents so the quotient is computed in HUGEINT.
    """
    a = f"CAST(round(({num}) * 100) AS HUGEINT)"
    b = f"CAST(round(({den}) * 100) AS HUGEINT)"
    k = 10 ** scale * times
    q = (f"(sign({a}) * sign({b}) * ((2 * abs({a}) * {k} + abs({b})) // (2 * abs({b}))))")
    unit = f"CAST({10 ** -scale:.{scale}f} AS DECIMAL({scale},{scale}))" if scale else "1"
    expr = (f"CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL "
            f"ELSE CAST(CAST({q} AS DECIMAL({38 - scale},0)) * {unit} AS DECIMAL(38,{scale})) END")
    if zero is not None:
        expr = f"coalesce({expr}, CAST({zero} AS DECIMAL(38,{scale})))"
    return expr


def pct_sql(num: str, den: str, scale: int = 2, zero=None) -> str:
    return ratio_sql(num, den, scale=scale, times=100, zero=zero)


CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


_cte("dim_status", [], f"""
SELECT CAST(k AS INTEGER) AS status_key, n AS status_name
FROM (VALUES {_values(fixed.STATUSES)}) t(k, n)""")

_cte("market_policy", [], f"""
SELECT country, local_currency, CAST(f AS DECIMAL(8,2)) AS price_factor,
       CAST(v AS DECIMAL(4,2)) AS vat_rate, CAST(x AS DECIMAL(18,5)) AS fx_rate
FROM (VALUES {_values([(r, c, str(f), str(v), str(x)) for r, c, f, v, x in fixed.market_rows()])})
     t(country, local_currency, f, v, x)""")

_cte("dim_campaign", [], f"""
SELECT CAST(k AS INTEGER) AS campaign_key, n AS campaign_name, ch AS channel,
       CAST(c AS DECIMAL(18,2)) AS campaign_cost, CAST(s AS DATE) AS start_date,
       CAST(e AS DATE) AS end_date
FROM (VALUES {_values([(k, n, ch, str(c), s, e) for k, n, ch, c, s, e in fixed.campaign_rows()])})
     t(k, n, ch, c, s, e)""")

_cte("date_bounds", [], """
SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS lo,
       make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31) AS hi
FROM orders""")

_cte("dim_date", ["date_bounds"], f"""
SELECT {date_key_sql('d')} AS date_key, d AS full_date, CAST(day(d) AS INTEGER) AS day_number,
       dayname(d) AS day_name, {week_sql('d')} AS week_number,
       CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       {fiscal_month_sql('d')} AS fiscal_month,
       CAST(ceil({fiscal_month_sql('d')} / 3) AS INTEGER) AS fiscal_quarter,
       {fiscal_year_sql('d')} AS fiscal_year,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM date_bounds)""")

_cte("dim_location", [], """
SELECT n.n_nationkey AS location_key, n.n_name AS city, n.n_name AS region, r.r_name AS country
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

_cte("location_market", ["dim_location", "market_policy"], """
SELECT l.*, m.local_currency, m.price_factor, m.vat_rate, m.fx_rate
FROM dim_location l LEFT JOIN market_policy m ON l.country = m.country""")

_cte("dim_product", [], f"""
SELECT p_partkey AS product_key, p_partkey + 101 AS product_id, p_name AS product_name,
       p_brand AS brand, p_type AS category, {size_band_sql('p_size')} AS sub_category,
       CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)), 2)
            AS DECIMAL(18,2)) AS standard_cost,
       CAST(p_retailprice AS DECIMAL(18,2)) AS selling_price
FROM part""")

_cte("customer_keys", [], f"""
SELECT c_custkey AS customer_key, CAST(c_custkey + 1 + {fixed.CUSTOMER_ID_BASE} AS BIGINT) AS customer_id,
       CASE WHEN (c_custkey + 1) % 2 = 0 THEN '{fixed.GENDER_EVEN}' ELSE '{fixed.GENDER_ODD}' END AS gender,
       {age_sql('(c_custkey + 1)')} AS age_group,
       {segment_sql('(c_custkey + 1)')} AS customer_segment,
       c_name AS customer_name, c_nationkey AS location_key
FROM customer""")

_cte("customer_first_order", [], """
SELECT o_custkey AS customer_key, CAST(min(o_orderdate) AS DATE) AS first_order_date
FROM orders GROUP BY o_custkey""")

_cte("dim_customer", ["customer_keys", "customer_first_order"], f"""
SELECT k.customer_key, k.customer_id, k.customer_name, k.gender, k.age_group, k.location_key,
       coalesce(f.first_order_date, DATE '{fixed.SIGNUP_FALLBACK}') AS signup_date,
       k.customer_segment,
       coalesce(f.first_order_date, DATE '{fixed.SIGNUP_FALLBACK}') AS valid_from,
       CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
FROM customer_keys k LEFT JOIN customer_first_order f ON k.customer_key = f.customer_key""")

_status = """CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 5
            WHEN l_returnflag = 'R' THEN 2
            WHEN l_returnflag = 'N' AND o_orderpriority = '5-LOW' THEN 3
            WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN 4
            ELSE 1 END AS INTEGER)"""

_sources = "CASE l_orderkey % 3 " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(fixed.ORDER_SOURCES)) + " END"

_cte("order_lines", ["location_market"], """
SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority,
       lm.location_key, lm.country, lm.local_currency, lm.price_factor, lm.vat_rate, lm.fx_rate,
       p.p_retailprice
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN location_market lm ON c.c_nationkey = lm.location_key
LEFT JOIN part p ON l.l_partkey = p.p_partkey""")

_cte("sales_base", ["order_lines"], f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_key,
       o_custkey AS customer_key, location_key, country, o_orderdate AS order_ts,
       CAST(o_orderdate AS DATE) AS order_date, {date_key_sql('o_orderdate')} AS date_key,
       CAST(l_orderkey % {len(fixed.CAMPAIGNS)} + 1 AS INTEGER) AS campaign_key,
       {_status} AS status_key,
       {_sources} AS order_source,
       CAST(l_quantity AS INTEGER) AS quantity, local_currency,
       CAST(fx_rate AS DECIMAL(18,4)) AS exchange_rate_to_usd, vat_rate,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * price_factor AS DECIMAL(18,2)) AS unit_price_local,
       CAST(CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)), 2)
                 AS DECIMAL(18,2)) * price_factor AS DECIMAL(18,2)) AS product_cost_local,
       CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
       l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate, l_quantity
FROM order_lines""")

_cte("sales_local", ["sales_base"], """
SELECT *,
       CAST(quantity * unit_price_local AS DECIMAL(18,2)) AS line_amount_local,
       CAST(round(CAST(quantity * unit_price_local AS DECIMAL(18,2)) * discount_rate, 2)
            AS DECIMAL(18,2)) AS discount_amount_local,
       CAST(round(unit_price_local * vat_rate, 2) AS DECIMAL(18,2)) AS tax_amount_local,
       CAST(quantity * product_cost_local AS DECIMAL(18,2)) AS line_cost_local
FROM sales_base""")

_cte("sales_lines", ["sales_local"], """
SELECT *,
       CAST(round(line_amount_local * exchange_rate_to_usd, 2) AS DECIMAL(18,2)) AS gross_revenue_usd,
       CAST(round(CAST(line_amount_local - discount_amount_local AS DECIMAL(18,2))
                  * exchange_rate_to_usd, 2) AS DECIMAL(18,2)) AS net_revenue_usd,
       CAST(round(tax_amount_local * exchange_rate_to_usd, 2) AS DECIMAL(18,2)) AS tax_usd,
       CAST(round(CAST(CAST(line_amount_local - discount_amount_local AS DECIMAL(18,2))
                       - line_cost_local AS DECIMAL(18,2)) * exchange_rate_to_usd, 2)
            AS DECIMAL(18,2)) AS profit_usd,
       CAST(round(line_cost_local * exchange_rate_to_usd, 2) AS DECIMAL(18,2)) AS cost_usd
FROM sales_local""")


# the snapshot covers the last calendar years with orders
_cte("inventory_days", ["dim_date"], f"""
SELECT * FROM dim_date WHERE year > (SELECT max(year) FROM dim_date) - {fixed.DEFAULTS["inventory_last_years"]}""")

_cte("fact_inventory", ["inventory_days", "dim_product", "sales_lines"], f"""
SELECT g.date_key, g.product_key, CAST({fixed.OPENING_STOCK} AS INTEGER) AS opening_stock,
       CAST(received AS INTEGER) AS stock_received, CAST(coalesce(sold, 0) AS INTEGER) AS stock_sold,
       CAST(returned AS INTEGER) AS stock_returned,
       CAST({fixed.OPENING_STOCK} + received - coalesce(sold, 0) AS INTEGER) AS closing_stock
FROM (SELECT date_key, product_key, if(day_number = 1, {fixed.RESTOCK_UNITS}, 0) AS received,
             if(day_number % {fixed.RETURN_DAY_MODULUS} = 0, {fixed.RETURNED_UNITS}, 0) AS returned
      FROM inventory_days, dim_product) g
LEFT JOIN (SELECT date_key, product_key, sum(quantity) AS sold FROM sales_lines GROUP BY ALL) s
USING (date_key, product_key)""")

_cte("campaign_days", ["dim_campaign", "dim_date"], f"""
SELECT d.date_key, c.campaign_key,
       {ratio_sql('c.campaign_cost', 'date_diff(' + "'day'" + ', c.start_date, c.end_date)')}
       ::DECIMAL(18,2) AS cost
FROM dim_date d JOIN dim_campaign c ON d.full_date BETWEEN c.start_date AND c.end_date""")

_cte("campaign_events", [], f"""
SELECT {date_key_sql("(CAST(ts AS DATE) + INTERVAL (" + str(fixed.EVENT_SHIFT_MONTHS) + ") MONTH)")}
         AS date_key,
       CAST(user_id % {len(fixed.CAMPAIGNS)} + 1 AS INTEGER) AS campaign_key,
       count(*) FILTER (WHERE event_type = 'view') AS impressions,
       count(*) FILTER (WHERE event_type = 'click') AS clicks,
       count(*) FILTER (WHERE event_type = 'purchase') AS conversions,
       sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS revenue
FROM events GROUP BY 1, 2""")

_cte("fact_marketing", ["campaign_days", "campaign_events"], """
SELECT d.date_key, d.campaign_key,
       coalesce(e.impressions, 0) AS impressions, coalesce(e.clicks, 0) AS clicks,
       coalesce(e.conversions, 0) AS conversions,
       CAST(coalesce(e.revenue, 0) AS DECIMAL(18,2)) AS revenue_generated, d.cost
FROM campaign_days d LEFT JOIN campaign_events e
  ON d.date_key = e.date_key AND d.campaign_key = e.campaign_key""")


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `body` with the conformance CTEs it needs (and `extra` ones)."""
    names = _order(list(needs))
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in names]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql.strip()})")
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
