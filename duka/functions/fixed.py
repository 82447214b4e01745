"""Fixed values of the warehouse: seed rows, label texts and business rules.

FIXED VALUES -- these must equal the values of the analytics being
reproduced (status names, campaign seed rows, market price factors, VAT
rates, currency codes, FX rates, label texts, stock constants). They are
stated here once, in their natural order; everything else derives from them.
"""

from __future__ import annotations

from decimal import Decimal

# ---------------------------------------------------------------- FIXED VALUES
# Order status dimension: (status_key, status_name).
STATUSES = [
    (1, "Completed"),
    (2, "Returned"),
    (3, "Cancelled"),
    (4, "Pending"),
    (5, "Refunded"),
]

# Campaign seed rows: (campaign_key, campaign_name, channel, campaign_cost).
CAMPAIGNS = [
    (1, "Black Friday Mega Sale", "Google Ads", Decimal("5000.00")),
    (2, "New Year New You", "Facebook Ads", Decimal("3500.00")),
    (3, "Summer Fashion Launch", "Instagram", Decimal("2800.00")),
    (4, "Tech Upgrade Campaign", "Email", Decimal("450.00")),
    (5, "Organic Tech Reviews", "Organic Search", Decimal("0.00")),
    (6, "Lifestyle Influencer Push", "Affiliate", Decimal("1200.00")),
]

# Market localisation: currency code, price factor from base price to local
# price, VAT rate and FX rate to USD (FX is stored at 4 decimals).
#   Kenya KES x130.00 16% 0.0077; Tanzania TZS x2600.00 15% 0.00038;
#   Uganda UGX x3700.00 18% 0.00027; Rwanda RWF x1200.00 18% 0.00078.
KES = ("KES", Decimal("130.00"), Decimal("0.16"), Decimal("0.0077"))
TZS = ("TZS", Decimal("2600.00"), Decimal("0.15"), Decimal("0.00038"))
UGX = ("UGX", Decimal("3700.00"), Decimal("0.18"), Decimal("0.00027"))
RWF = ("RWF", Decimal("1200.00"), Decimal("0.18"), Decimal("0.00078"))

# Order source by order id modulo 3: 0, 1, 2.
ORDER_SOURCES = ["Website", "Mobile App", "Marketplace"]

# Customer attribute rules on the 1-based customer number n.
SEGMENT_RULES = [(10, "Platinum"), (5, "Gold"), (3, "Silver")]   # first n % k == 0 wins
SEGMENT_DEFAULT = "Bronze"
GENDER_EVEN, GENDER_ODD = "Female", "Male"                     # n % 2
AGE_GROUPS = ["18-24", "25-34", "35-54", "55+"]                # n % 4 = 0, 1, 2, 3
CUSTOMER_ID_BASE = 2000                                        # customer_id = base + n

# Inventory snapshot constants.
OPENING_STOCK = 150
RESTOCK_UNITS = 100        # received on day 1 of each month
RETURNED_UNITS = 2         # returned on days divisible by 15
RETURN_DAY_MODULUS = 15
OVERSTOCK_FACTOR = 3       # closing > 3 x sold -> overstocked

# Labels.
STOCK_DEAD = "Dead Stock (No Sales)"
STOCK_OVER = "Overstocked"
STOCK_OK = "Healthy Turnover"
RFM_CHAMPIONS = "Core Champions (VIP)"
RFM_AT_RISK = "At Churn Risk (High Value)"
RFM_PROMISING = "New Promising Leads"
RFM_HIBERNATING = "Hibernating / Price Sensitive"

# Prefix of a generated customer name.
GENERATED_NAME = "Customer_Name_"

# Fiscal year starts in July (month 7).
FISCAL_START_MONTH = 7
# ------------------------------------------------------------ END FIXED VALUES

# Our mapping of the driver data onto the fixed values above (not reference
# values): which region trades in which market, campaign windows re-dated to
# the span of the order data, and the status rule over order-line flags.
REGION_MARKET = {
    "AFRICA": KES,
    "AMERICA": TZS,
    "ASIA": UGX,
    "EUROPE": RWF,
    "MIDDLE EAST": ("USD", Decimal("1.00"), Decimal("0.16"), Decimal("1.0")),
}

CAMPAIGN_WINDOWS = {
    1: ("2000-01-20", "2000-01-30"),
    2: ("2000-01-01", "2000-01-15"),
    3: ("2000-01-16", "2000-01-30"),
    4: ("2000-01-10", "2000-01-17"),
    5: ("1999-01-01", "2001-12-31"),
    6: ("2000-01-01", "2000-01-31"),
}

# Signup date of a customer without orders (first day of the order data).
SIGNUP_FALLBACK = "1995-01-01"

# Events are shifted back this many months so their days overlap the orders.
EVENT_SHIFT_MONTHS = -288

# Product size band (sub-category) by p_size upper bound.
SIZE_BANDS = [(15, "Small"), (35, "Medium"), (50, "Large")]

# SCD2 tier by number of orders a customer placed in a calendar year.
TIER_BY_ORDERS = [(4, "Platinum"), (3, "Gold"), (2, "Silver")]
TIER_DEFAULT = "Bronze"

# Default parameters of the parameterised queries on the driver data.
DEFAULTS = {
    "target_year": 2000,
    "customer_id": 2005,
    "top_n": 3,
    "category": "PROMO",
    "channel": "Facebook Ads",
    "rfm_as_of": "2001-08-01",
    "dead_stock_cutoff_key": 20010501,
    "basket_min_pairs": 5,
    # the stock snapshot covers this many calendar years, up to the last one with orders
    "inventory_last_years": 2,
    # `scd2_incremental` merges the years from this one on first, the others after
    "history_split_year": 1998,
    # an order of more lines than this is numbered by several tasks
    "hot_order_lines": 1_000_000,
    "sample_n": 100,
    "sample_seed": "duka",
}


def status_key(name: str) -> int:
    for key, label in STATUSES:
        if label == name:
            return key
    raise KeyError(name)


def status_keys(*names: str) -> list[int]:
    return [status_key(n) for n in names]


def market_rows():
    """(region, currency, factor, vat, fx) rows in region order."""
    return [(region, *REGION_MARKET[region]) for region in sorted(REGION_MARKET)]


def campaign_rows():
    """(key, name, channel, cost, start, end) rows."""
    return [(k, n, ch, cost, *CAMPAIGN_WINDOWS[k]) for k, n, ch, cost in CAMPAIGNS]
