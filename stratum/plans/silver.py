"""Silver: valid orders with revenue, fulfilment, date and customer attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum.operators.joins import fits_broadcast, left_join
from stratum.sources.scratch import materialize

KEY = "order_id"
CLUSTER_BY = ("order_date", "region")
CUSTOMER_COLUMNS = ("customer_name", "customer_segment", "country", "city", "account_manager")


_GIVEN = (
    "order_id", "customer_id", "product_id", "order_date", "shipped_date", "quantity", "unit_price", "discount_pct",
    "status", "region", "channel",
)


def flagged_orders(orders: DataFrame, *more: str) -> DataFrame:
    """Typed orders with every derived column that needs no customer, their data-quality flag, and more of their columns."""
    dims = fx.date_dims()
    return orders.select(
        *_GIVEN,
        fx.gross_revenue().alias("gross_revenue"),
        fx.net_revenue().alias("net_revenue"),
        fx.discount_amount().alias("discount_amount"),
        fx.days_between("order_date", "shipped_date").alias("days_to_ship"),
        fx.shipped_on_time().alias("shipped_on_time"),
        *[expression.alias(name) for name, expression in dims.items()],
        fx.dq_flag().alias("dq_flag"),
        "_loaded_at",
        *more,
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """The valid orders, before customer attributes are attached."""
    return flagged_orders(orders).filter(F.col("dq_flag") == "ok")


def valid_orders(orders: DataFrame) -> DataFrame:
    """The valid orders with their given columns only; all others can be derived after these have moved."""
    return orders.filter(fx.dq_flag() == "ok").select(*_GIVEN, "_loaded_at")


def int_orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    processed_at: Column | dt.datetime | str | None = None,
    broadcast_customers: bool | None = None,
    ranged_by: Sequence[str] = (),
) -> DataFrame:
    """Valid orders with their customer's attributes; an unknown customer leaves those NULL.

    Columns are derived after the join, so a join that shuffles carries the given ones only. With ``ranged_by`` the rows
    are dealt out by ranges of those columns (of silver, made from an order alone) and the key; that shuffle carries
    the given columns, and the customer's only where customers aren't broadcast after it. Then the joined rows are stored
    in between, in the scratch tables of the caller, so that the two shuffles are not on the disks at once.
    """
    given = valid_orders(orders)
    people = customers.select("customer_id", *CUSTOMER_COLUMNS)
    if broadcast_customers is None:
        broadcast_customers = fits_broadcast(people)
    derived = fx.date_dims()
    ranges = [*[derived.get(c, F.col(c)) for c in ranged_by], F.col(KEY)]
    if ranged_by and broadcast_customers:
        given = given.repartitionByRange(*ranges)
    joined = left_join(given, people, "customer_id", spread_by=KEY, broadcast=broadcast_customers)
    if ranged_by and not broadcast_customers:
        joined = materialize(joined, "joined-orders").repartitionByRange(*ranges)
    enriched = flagged_orders(joined, *CUSTOMER_COLUMNS)
    stamp = fx.as_timestamp(processed_at, "timestamp").alias("_transformed_at")
    return enriched.select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "shipped_date",
        "quantity",
        "unit_price",
        "discount_pct",
        "status",
        "region",
        "channel",
        "gross_revenue",
        "net_revenue",
        "discount_amount",
        "days_to_ship",
        "shipped_on_time",
        *CUSTOMER_COLUMNS,
        "order_month",
        "order_quarter",
        "order_year",
        "order_dow",
        "dq_flag",
        "_loaded_at",
        stamp,
    )
