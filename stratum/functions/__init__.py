"""Column functions and generators; all stay inside Catalyst, none is a Python UDF."""

from stratum.functions.expressions import (
    as_date,
    as_timestamp,
    churn_risk,
    customer_tier,
    date_dims,
    days_between,
    discount_amount,
    dq_flag,
    gross_revenue,
    hours_between,
    net_revenue,
    percent,
    revenue_bands,
    safe_divide,
    shipped_on_time,
    surrogate_key,
)
from stratum.functions.generators import date_spine, spine_dates

__all__ = [
    "as_date",
    "as_timestamp",
    "churn_risk",
    "customer_tier",
    "date_dims",
    "date_spine",
    "days_between",
    "discount_amount",
    "dq_flag",
    "gross_revenue",
    "hours_between",
    "net_revenue",
    "percent",
    "revenue_bands",
    "safe_divide",
    "shipped_on_time",
    "spine_dates",
    "surrogate_key",
]
