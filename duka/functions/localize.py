"""Per-line money rules: local amounts, discount, VAT and USD measures.

Input columns: quantity, unit_price_local, product_cost_local (decimal(18,2)),
discount_rate (decimal(4,2)), vat_rate (decimal(4,2)) and
exchange_rate_to_usd (decimal(18,4)). Every amount is exact decimal
arithmetic, rounded to cents once, half away from zero. VAT is charged on
one unit (not times quantity), as in the load rules being reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duka.functions.money import money, round_money


def line_amounts() -> dict[str, Column]:
    """The line's amount and cost."""
    q = F.col("quantity")
    return {"line_amount_local": money(q * F.col("unit_price_local")),
            "line_cost_local": money(q * F.col("product_cost_local"))}


def cost_usd() -> Column:
    return round_money(F.col("line_cost_local") * F.col("exchange_rate_to_usd"))


def line_measures(df: DataFrame) -> DataFrame:
    amounts = line_amounts()
    line_local = amounts["line_amount_local"]
    with_local = df.withColumns({
        "line_amount_local": line_local,
        "discount_amount_local": round_money(line_local * F.col("discount_rate")),
        "tax_amount_local": round_money(F.col("unit_price_local") * F.col("vat_rate")),
        "line_cost_local": amounts["line_cost_local"],
    })
    fx = F.col("exchange_rate_to_usd")
    net_local = money(F.col("line_amount_local") - F.col("discount_amount_local"))
    return with_local.withColumns({
        "gross_revenue_usd": round_money(F.col("line_amount_local") * fx),
        "net_revenue_usd": round_money(net_local * fx),
        "tax_usd": round_money(F.col("tax_amount_local") * fx),
        "profit_usd": round_money(money(net_local - F.col("line_cost_local")) * fx),
        "cost_usd": cost_usd(),
    })
