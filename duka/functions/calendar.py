"""Calendar expressions (JVM-side Column expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duka.functions.fixed import FISCAL_START_MONTH


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(d) -> Column:
    """yyyymmdd as int."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k) -> Column:
    k = _c(k)
    return F.make_date((k / 10000).cast("int"), ((k / 100).cast("int") % 100), k % 100)


def sunday_week_number(d) -> Column:
    """Week of year where weeks start on Sunday and week 1 holds 1 January."""
    d = _c(d)
    jan1_dow = F.dayofweek(F.trunc(d, "YEAR"))          # Sunday = 1
    return (F.floor((F.dayofyear(d) + jan1_dow - 2) / 7) + 1).cast("int")


def fiscal_month(d) -> Column:
    m = F.month(_c(d))
    return F.when(m >= FISCAL_START_MONTH, m - (FISCAL_START_MONTH - 1)) \
        .otherwise(m + (13 - FISCAL_START_MONTH)).cast("int")


def fiscal_quarter(d) -> Column:
    return F.ceil(fiscal_month(d) / 3).cast("int")


def fiscal_year(d) -> Column:
    """Fiscal year labelled by the calendar year it starts in."""
    d = _c(d)
    return F.when(F.month(d) >= FISCAL_START_MONTH, F.year(d)).otherwise(F.year(d) - 1).cast("int")


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def month_start(d) -> Column:
    return F.trunc(_c(d), "MM")


def month_boundaries_between(a, b) -> Column:
    """Number of month boundaries crossed from a to b (31 Jan -> 1 Feb is 1)."""
    a, b = _c(a), _c(b)
    return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("int")


def month_index(year, month) -> Column:
    """Months since year 0; consecutive months differ by 1."""
    return (_c(year) * 12 + _c(month) - 1).cast("int")


def month_name_of(year, month) -> Column:
    """Month name from (year, month) ints: computed on aggregated rows, so
    reports group by integers and format names once per output row."""
    return F.date_format(F.make_date(_c(year), _c(month), F.lit(1)), "MMMM")


def year_of_key(k) -> Column:
    return (_c(k) / 10000).cast("int")


def month_of_key(k) -> Column:
    return ((_c(k) / 100).cast("int") % 100).cast("int")


def calendar_columns(d) -> dict[str, Column]:
    """All calendar dimension columns derived from a date column."""
    d = _c(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_number": F.dayofmonth(d),
        "day_name": F.date_format(d, "EEEE"),
        "week_number": sunday_week_number(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "fiscal_month": fiscal_month(d),
        "fiscal_quarter": fiscal_quarter(d),
        "fiscal_year": fiscal_year(d),
        "is_weekend": is_weekend(d),
    }
