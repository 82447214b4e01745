"""Target schemas of the warehouse tables.

The load scripts fix every table's columns and types in DDL; here the same
contract is a DDL string per table, checked against the DataFrames before
they are written (a metadata comparison, no job). Keys, references and
NULL rules are checked by the data-quality queries, not at write time.
Driver keys are bigint and kept so (order, part and customer numbers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

TABLES: dict[str, str] = {
    "dim_date": "date_key int, full_date date, day_number int, day_name string, "
                "week_number int, month_number int, month_name string, quarter int, year int, "
                "fiscal_month int, fiscal_quarter int, fiscal_year int, is_weekend boolean",
    "dim_location": "location_key int, city string, region string, country string",
    "dim_customer": "customer_key bigint, customer_id bigint, customer_name string, "
                    "gender string, age_group string, location_key int, signup_date date, "
                    "customer_segment string, valid_from date, valid_to date, "
                    "is_current boolean",
    "customer_versions": "customer_key bigint, customer_id bigint, customer_version_key bigint, "
                         "version int, customer_segment string, valid_from date, valid_to date, "
                         "is_current boolean",
    "dim_product": "product_key bigint, product_id bigint, product_name string, brand string, "
                   "category string, sub_category string, standard_cost decimal(18,2), "
                   "selling_price decimal(18,2)",
    "dim_campaign": "campaign_key int, campaign_name string, channel string, "
                    "campaign_cost decimal(18,2), start_date date, end_date date",
    "dim_status": "status_key int, status_name string",
    "fact_sales": "sales_fact_key bigint, order_id bigint, order_line_number int, date_key int, "
                  "customer_key bigint, customer_version_key bigint, product_key bigint, "
                  "location_key int, campaign_key int, "
                  "status_key int, order_source string, quantity int, local_currency string, "
                  "exchange_rate_to_usd decimal(18,4), unit_price_local decimal(18,2), "
                  "discount_amount_local decimal(18,2), tax_amount_local decimal(18,2), "
                  "product_cost_local decimal(18,2), gross_revenue_usd decimal(18,2), "
                  "net_revenue_usd decimal(18,2), tax_usd decimal(18,2), profit_usd decimal(18,2)",
    "fact_inventory": "date_key int, product_key bigint, opening_stock int, stock_received int, "
                      "stock_sold int, stock_returned int, closing_stock int",
    "fact_marketing": "date_key int, campaign_key int, impressions bigint, clicks bigint, "
                      "conversions bigint, revenue_generated decimal(18,2), cost decimal(18,2)",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def check(df: DataFrame, table: str) -> DataFrame:
    """Raise if `df` lacks a column of the table's schema or types it
    differently (extra columns are allowed: the stored fact keeps its
    derived helper columns). Returns `df` unchanged."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in schema(table).fields:
        if field.name not in have:
            problems.append(f"missing {field.name}")
        elif have[field.name] != field.dataType:
            problems.append(f"{field.name}: {have[field.name].simpleString()} "
                            f"!= {field.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{table} does not match its schema: " + "; ".join(problems))
    return df
