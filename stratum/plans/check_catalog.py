"""The declared checks of every table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from stratum.operators.checks import (
    Check,
    accepted_range,
    accepted_values,
    not_null,
    relationships,
    unique,
)

# Accepted domains and the declared checks, table by table.
STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled", "returned")
REGIONS = ("North", "South", "East", "West", "International")
CHANNELS = ("online", "retail", "partner", "direct")
SEGMENTS = ("Enterprise", "SMB", "Consumer")
CHURN_RISKS = ("high", "medium", "low")
TIERS = ("Platinum", "Gold", "Silver", "Bronze")

RAW_ORDERS = [
    unique("order_id"),
    not_null("order_id"),
    not_null("customer_id"),
    not_null("order_date"),
]

RAW_CUSTOMERS = [
    unique("customer_id"),
    not_null("customer_id"),
    unique("email"),
    not_null("email"),
]

STG_ORDERS = [
    unique("order_id"),
    not_null("order_id"),
    not_null("customer_id"),
    not_null("product_id"),
    not_null("order_date"),
    not_null("unit_price"),
    accepted_range("unit_price", 0, 1000000),
    not_null("quantity"),
    accepted_range("quantity", 1, 10000),
    accepted_range("discount_pct", 0, 100),
    not_null("status"),
    accepted_values("status", *STATUSES),
    not_null("region"),
    accepted_values("region", *REGIONS),
    not_null("channel"),
    accepted_values("channel", *CHANNELS),
    not_null("_loaded_at"),
]

STG_CUSTOMERS = [
    unique("customer_id"),
    not_null("customer_id"),
    not_null("customer_name"),
    not_null("email"),
    unique("email"),
    not_null("country"),
    not_null("customer_segment"),
    accepted_values("customer_segment", *SEGMENTS),
    not_null("signup_date"),
    not_null("is_active"),
]

INT_ORDERS_ENRICHED = [
    unique("order_id"),
    not_null("order_id"),
    not_null("customer_id"),
    relationships("customer_id", to="stg_customers"),
    not_null("gross_revenue"),
    accepted_range("gross_revenue", minimum=0),
    not_null("net_revenue"),
    accepted_range("net_revenue", minimum=0),
    accepted_range("discount_amount", minimum=0),
    accepted_range("days_to_ship", 0, 365),
    not_null("order_month"),
    not_null("order_year"),
    accepted_values("customer_segment", *SEGMENTS),
    not_null("dq_flag"),
    accepted_values("dq_flag", "ok"),
    not_null("_loaded_at"),
    not_null("_transformed_at"),
]

MART_REVENUE_BY_SEGMENT = [
    not_null("order_month"),
    not_null("customer_segment"),
    accepted_values("customer_segment", *SEGMENTS),
    not_null("region"),
    not_null("gross_revenue"),
    accepted_range("gross_revenue", minimum=0),
    not_null("net_revenue"),
    accepted_range("net_revenue", minimum=0),
    not_null("order_count"),
    accepted_range("order_count", minimum=1),
    accepted_range("unique_customers", minimum=1),
    accepted_range("on_time_delivery_pct", 0, 100),
]

MART_CUSTOMER_360 = [
    unique("customer_id"),
    not_null("customer_id"),
    unique("email"),
    not_null("email"),
    not_null("customer_segment"),
    accepted_values("customer_segment", *SEGMENTS),
    accepted_range("lifetime_gross_revenue", minimum=0),
    accepted_range("lifetime_net_revenue", minimum=0),
    not_null("lifetime_order_count"),
    accepted_range("lifetime_order_count", minimum=0),
    accepted_range("days_since_last_order", minimum=0),
    accepted_range("recency_score", 1, 5),
    accepted_range("frequency_score", 1, 5),
    accepted_range("monetary_score", 1, 5),
    not_null("rfm_total"),
    accepted_range("rfm_total", 3, 15),
    not_null("churn_risk"),
    accepted_values("churn_risk", *CHURN_RISKS),
    not_null("customer_tier"),
    accepted_values("customer_tier", *TIERS),
    not_null("_refreshed_at"),
]

CATALOG: dict[str, list[Check]] = {
    "raw_orders": RAW_ORDERS,
    "raw_customers": RAW_CUSTOMERS,
    "stg_orders": STG_ORDERS,
    "stg_customers": STG_CUSTOMERS,
    "int_orders_enriched": INT_ORDERS_ENRICHED,
    "mart_revenue_by_segment": MART_REVENUE_BY_SEGMENT,
    "mart_customer_360": MART_CUSTOMER_360,
}


def checks_for(model: str, warn_only: Iterable[tuple[str, str]] = ()) -> list[Check]:
    """The checks of a model; those named as (model, check name) in ``warn_only`` report without blocking."""
    lowered = {name for owner, name in warn_only if owner == model}
    return [replace(c, severity="warn") if c.name in lowered else c for c in CATALOG[model]]
