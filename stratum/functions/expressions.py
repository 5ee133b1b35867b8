"""Reusable column expressions: revenue, fulfilment, classification, keys and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.schemas import GROSS_TYPE, NET_TYPE

# Business thresholds and labels.
ON_TIME_DAYS = 2
CHURN_HIGH_DAYS = 180
CHURN_MEDIUM_DAYS = 90
TIER_PLATINUM = 100000
TIER_GOLD = 25000
TIER_SILVER = 5000
REVENUE_BANDS = [(1000, "< $1K"), (10000, "$1K–$10K"), (100000, "$10K–$100K")]
REVENUE_BAND_TOP = "> $100K"
KEY_SEPARATOR = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: Column | dt.date | str | None) -> Column:
    """A date column from a column, a date, an ISO string or, for None, today."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def as_timestamp(value: Column | dt.datetime | str | None, kind: str = "timestamp_ntz") -> Column:
    """A timestamp column from a column, a datetime, an ISO string or, for None, now."""
    if value is None:
        return F.current_timestamp().cast(kind)
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return (value if isinstance(value, Column) else F.lit(value)).cast(kind)


# --- arithmetic ---------------------------------------------------------------------------


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, NULL where the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double, NULL where whole is 0."""
    return safe_divide(part, whole) * 100


def gross_revenue(quantity="quantity", unit_price="unit_price") -> Column:
    return (_col(quantity) * _col(unit_price)).cast(GROSS_TYPE)


def net_revenue(quantity="quantity", unit_price="unit_price", discount_pct="discount_pct") -> Column:
    """Revenue after the discount, exact to six decimals."""
    kept = (F.lit(100) - _col(discount_pct)) * F.lit("0.01").cast("decimal(3,2)")
    return (gross_revenue(quantity, unit_price) * kept).cast(NET_TYPE)


def discount_amount(quantity="quantity", unit_price="unit_price", discount_pct="discount_pct") -> Column:
    taken = _col(discount_pct) * F.lit("0.01").cast("decimal(3,2)")
    return (gross_revenue(quantity, unit_price) * taken).cast(NET_TYPE)


# --- fulfilment and dates -----------------------------------------------------------------


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; negative when end is earlier."""
    return F.datediff(_col(end), _col(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed from start to end (00:59 to 02:01 counts 2)."""

    def hour_number(c):
        day = F.datediff(_col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        return day * 24 + F.hour(_col(c))

    return hour_number(end) - hour_number(start)


def shipped_on_time(order_date="order_date", shipped_date="shipped_date") -> Column:
    """True when shipped within two days of the order; unshipped orders are not on time."""
    return F.coalesce(_col(shipped_date) <= F.date_add(_col(order_date), ON_TIME_DAYS), F.lit(False))


def date_dims(order_date="order_date") -> dict[str, Column]:
    """Month, quarter, year and weekday (0 = Sunday) of a date, by output column name."""
    d = _col(order_date)
    return {
        "order_month": F.trunc(d, "month"),
        "order_quarter": F.trunc(d, "quarter"),
        "order_year": F.year(d),
        "order_dow": F.dayofweek(d) - 1,
    }


# --- classification -----------------------------------------------------------------------


def dq_flag(unit_price="unit_price", quantity="quantity", customer_id="customer_id") -> Column:
    """First data-quality fault of an order row, or ok; a NULL price or quantity is no fault."""
    return (
        F.when(_col(unit_price) <= 0, "invalid_price")
        .when(_col(quantity) <= 0, "invalid_quantity")
        .when(_col(customer_id).isNull(), "missing_customer")
        .otherwise("ok")
    )


def churn_risk(days_since_last_order="days_since_last_order") -> Column:
    d = _col(days_since_last_order)
    return F.when(d > CHURN_HIGH_DAYS, "high").when(d > CHURN_MEDIUM_DAYS, "medium").otherwise("low")


def customer_tier(lifetime_net_revenue="lifetime_net_revenue") -> Column:
    r = _col(lifetime_net_revenue)
    return (
        F.when(r > TIER_PLATINUM, "Platinum")
        .when(r > TIER_GOLD, "Gold")
        .when(r > TIER_SILVER, "Silver")
        .otherwise("Bronze")
    )


def revenue_bands(revenue: Column | str) -> Column:
    """Label of the revenue band; NULL falls into the top band, as does exactly 100000."""
    (first, label), *rest = REVENUE_BANDS
    bands = F.when(_col(revenue) < first, label)
    for limit, label in rest:
        bands = bands.when(_col(revenue) < limit, label)
    return bands.otherwise(REVENUE_BAND_TOP)


# --- keys ---------------------------------------------------------------------------------


def surrogate_key(*fields: Column | str, null_as: str | None = None) -> Column:
    """md5 of the fields joined by a bar.

    One NULL field makes the whole text NULL, so every such row gets the md5 of the empty string.
    ``null_as`` replaces NULL field by field instead.
    """
    parts: list[Column] = []
    for field in fields:
        text = _col(field).cast("string")
        if null_as is not None:
            text = F.coalesce(text, F.lit(null_as))
        if parts:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(text)
    return F.md5(F.coalesce(F.concat(*parts), F.lit("")))
