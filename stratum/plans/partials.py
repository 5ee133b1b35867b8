"""Gold kept up from stored partial aggregates: only months of silver that have changed are read again.

Two tables stand between silver and the marts, both by month: the measures of each segment, region and channel, and
the sums of each customer. Every month carries the versions of the silver partitions that it was made from, so a
refresh finds the months whose partitions were written, emptied or added since, makes those anew and leaves all
others. The marts are then made from the partial rows, which are a few per month and segment, or one per month and
customer, however many orders there are.

A month's distinct counts are made from the whole month. The key of silver keeps an order in one month only, so a
customer's orders and months add up over months.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum import schemas
from stratum.operators.checks import proven_unique
from stratum.plans import gold
from stratum.schemas import GROSS_SUM_TYPE, NET_SUM_TYPE, SILVER_TYPES
from stratum.sources import versions
from stratum.sources.layers import LayerStore

MONTHLY, CUSTOMERS = "monthly_segment", "customer_months"
_LAYER = "partials"


def month_of(part: str | None) -> str | None:
    """The month, as text, of a partition by month or by day."""
    return None if part is None else part[:8] + "01"


def _sources(silver: versions.Snapshot) -> dict[str | None, str]:
    found: dict[str | None, list[str]] = {}
    for part in silver.parts:
        found.setdefault(month_of(part.part), []).append(f"{part.part}:{part.version}")
    return {month: ",".join(sorted(own)) for month, own in found.items()}


def stale_months(silver: versions.Snapshot, derived: versions.Snapshot | None) -> set[str | None]:
    """Months whose partial rows are not, or no longer, those of silver."""
    made = {p.part: p.source for p in derived.parts} if derived else {}
    wanted = _sources(silver)
    return {m for m in wanted.keys() | made.keys() if wanted.get(m) != made.get(m)}


def customer_months(orders: DataFrame) -> DataFrame:
    """What a month of a customer's orders adds to the customer's metrics."""
    return orders.groupBy("order_month", "customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("gross_revenue").cast(GROSS_SUM_TYPE).alias("gross"),
        F.sum("net_revenue").cast(NET_SUM_TYPE).alias("net"),
        F.count("net_revenue").alias("priced"),
        F.max("net_revenue").alias("max_single_order"),
        F.sum("discount_amount").cast(NET_SUM_TYPE).alias("discounts"),
        F.sum("days_to_ship").alias("days_to_ship"),
        F.count("days_to_ship").alias("shipped"),
        F.sum(F.when(F.col("shipped_on_time"), 1).otherwise(0)).alias("on_time"),
    )


def metrics_of(months: DataFrame, as_of: Column | dt.date | str | None = None) -> DataFrame:
    """``gold.customer_metrics`` from the months of each customer."""
    first, last, net = F.min("first_order_date"), F.max("last_order_date"), F.sum("net").cast(NET_SUM_TYPE)
    return months.groupBy("customer_id").agg(
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        fx.days_between(first, last).alias("customer_tenure_days"),
        F.sum("orders").alias("lifetime_order_count"),
        F.count("order_month").alias("active_months"),
        F.sum("gross").cast(GROSS_SUM_TYPE).alias("lifetime_gross_revenue"),
        net.alias("lifetime_net_revenue"),
        fx.safe_divide(net, F.sum("priced")).alias("avg_order_value"),
        F.max("max_single_order").alias("max_single_order"),
        F.sum("discounts").cast(NET_SUM_TYPE).alias("total_discounts_received"),
        fx.days_between(last, fx.as_date(as_of)).alias("days_since_last_order"),
        fx.safe_divide(F.sum("days_to_ship"), F.sum("shipped")).alias("avg_days_to_ship"),
        fx.percent(F.sum("on_time"), F.sum("n_rows")).alias("pct_orders_on_time"),
    )


def refresh(store: LayerStore, silver_model: str) -> dict[str, set[str | None]]:
    """Bring both partial tables up to silver; returns the months that were made anew, by table."""
    silver = store.snapshot("silver", silver_model)
    builders = {MONTHLY: _monthly_segment, CUSTOMERS: customer_months}
    return {name: _refresh(store, silver, name, build) for name, build in builders.items()}


def _monthly_segment(orders: DataFrame) -> DataFrame:
    """Where order ids are shown to be unique no row per order is shuffled to count them."""
    return gold.monthly_segment(orders, proven_unique(orders, "order_id"))


def _refresh(store: LayerStore, silver: versions.Snapshot, name: str, build) -> set[str | None]:
    path = store.path(_LAYER, name)
    derived = versions.current(store.spark, path)
    months = stale_months(silver, derived)
    if derived is not None and not months:
        return set()
    parts = [p for p in silver.parts if month_of(p.part) in months]
    orders = versions.read(store.spark, silver.path, SILVER_TYPES, silver, parts)
    # One file a month: a month's partial rows are few.
    rows = build(orders).repartition("order_month")
    layout = versions.Layout("order_month", sources=_sources(silver))
    versions.commit(
        store.spark, rows, path, layout, dict(rows.dtypes), derived, replaces=None if derived is None else months
    )
    return months


def mart_revenue_by_segment(store: LayerStore, start_date: Column | dt.date | str = gold.START_DATE) -> DataFrame:
    """The revenue mart from whole months; the start has to be the first of one."""
    monthly = store.read(_LAYER, MONTHLY, _types(gold.monthly_segment(_no_orders(store))))
    rows = monthly.filter(F.col("order_month") >= fx.as_date(start_date))
    mart = gold.with_month_over_month(rows)
    return mart.orderBy(F.desc_nulls_first("order_month"), F.desc_nulls_first("net_revenue"))


def customer_metrics(store: LayerStore, as_of: Column | dt.date | str | None = None) -> DataFrame:
    return metrics_of(store.read(_LAYER, CUSTOMERS, _types(customer_months(_no_orders(store)))), as_of)


def _no_orders(store: LayerStore) -> DataFrame:
    return store.spark.createDataFrame([], schemas.struct(SILVER_TYPES))


def _types(rows: DataFrame) -> dict[str, str]:
    return dict(rows.dtypes)
