"""Gold: monthly revenue by segment, and one row per customer with lifetime metrics and scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum.operators.ranking import Ranking, add_ntiles
from stratum.schemas import GROSS_SUM_TYPE, NET_SUM_TYPE
from stratum.sources.scratch import materialize

# Fixed value: the revenue mart starts here unless told otherwise.
START_DATE = "2023-01-01"
SEGMENT_KEYS = ("order_month", "order_year", "customer_segment", "region", "channel")
SEGMENT_COLUMNS = (
    *SEGMENT_KEYS,
    "order_count",
    "unique_customers",
    "total_units",
    "gross_revenue",
    "net_revenue",
    "total_discounts",
    "avg_order_value",
    "avg_days_to_ship",
    "on_time_delivery_pct",
)
#: What both marts read of silver.
SILVER_COLUMNS = (
    "order_id", "customer_id", "order_date", "quantity", "region", "channel", "gross_revenue", "net_revenue",
    "discount_amount", "days_to_ship", "shipped_on_time", "customer_segment", "order_month", "order_year",
)
CUSTOMER_360_CLUSTER_BY = ("customer_segment", "country")
TILES = 5
RFM_SCORES = ("recency_score", "frequency_score", "monetary_score")


def _order_measures(order_ids_unique: bool) -> dict[str, Column]:
    """Measures of a group of orders that both marts need, under the names of neither.

    Where order ids are known to be unique (they are the key of the silver table) their distinct count is a
    plain count. One distinct count in an aggregate is computed by first summing per group and counted value inside
    each task: no rows are multiplied and no group gathers in one task. Two of them would multiply the rows to be
    shuffled, so each aggregate of this module holds one at most.
    """
    orders = F.count("order_id") if order_ids_unique else F.countDistinct("order_id")
    net = F.sum("net_revenue").cast(NET_SUM_TYPE)
    on_time = F.sum(F.when(F.col("shipped_on_time"), 1).otherwise(0))
    return {
        "orders": orders,
        "gross": F.sum("gross_revenue").cast(GROSS_SUM_TYPE),
        "net": net,
        "discounts": F.sum("discount_amount").cast(NET_SUM_TYPE),
        "avg_order_value": fx.safe_divide(net, F.count("net_revenue")),
        "avg_days_to_ship": F.avg("days_to_ship"),
        "on_time": fx.percent(on_time, F.count(F.lit(1))),
    }


def monthly_segment(orders: DataFrame, order_ids_unique: bool = False) -> DataFrame:
    """Volume, revenue and fulfilment per month, segment, region and channel.

    Customers are counted by an aggregate of their own that reads only them, unless that is the only distinct count.
    The two meet group by group.
    """
    m = _order_measures(order_ids_unique)
    unique_customers = F.countDistinct("customer_id").alias("unique_customers")
    measures = [
        m["orders"].alias("order_count"),
        F.sum("quantity").alias("total_units"),
        m["gross"].alias("gross_revenue"),
        m["net"].alias("net_revenue"),
        m["discounts"].alias("total_discounts"),
        m["avg_order_value"].alias("avg_order_value"),
        m["avg_days_to_ship"].alias("avg_days_to_ship"),
        m["on_time"].alias("on_time_delivery_pct"),
    ]
    if order_ids_unique:
        rows = orders.groupBy(*SEGMENT_KEYS).agg(unique_customers, *measures)
    else:
        counted = orders.groupBy(*[F.col(k).alias(f"_{k}") for k in SEGMENT_KEYS]).agg(unique_customers)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in SEGMENT_KEYS])
        rows = orders.groupBy(*SEGMENT_KEYS).agg(*measures).join(counted, same)
    return rows.select(*SEGMENT_COLUMNS)


def with_month_over_month(monthly: DataFrame) -> DataFrame:
    """Add revenue of the previous present month, and the change against it.

    A window holds one row per month of one segment, region and channel, however many orders there are.
    """
    window = Window.partitionBy("customer_segment", "region", "channel").orderBy("order_month")
    previous, net = F.col("prev_month_revenue"), F.col("net_revenue")
    return monthly.withColumn("prev_month_revenue", F.lag("net_revenue").over(window)).select(
        *monthly.columns,
        "prev_month_revenue",
        (net - previous).cast(NET_SUM_TYPE).alias("revenue_mom_delta"),
        fx.percent(net - previous, previous).alias("revenue_mom_growth_pct"),
    )


def mart_revenue_by_segment(
    silver: DataFrame,
    start_date: Column | dt.date | str = START_DATE,
    order_ids_unique: bool = False,
) -> DataFrame:
    start = fx.as_date(start_date)
    # Silver is laid out by month: the second condition lets whole months be skipped.
    orders = silver.filter((F.col("order_date") >= start) & (F.col("order_month") >= F.trunc(start, "month")))
    mart = with_month_over_month(monthly_segment(orders, order_ids_unique))
    return mart.orderBy(F.desc_nulls_first("order_month"), F.desc_nulls_first("net_revenue"))


def customer_metrics(
    silver: DataFrame,
    as_of: Column | dt.date | str | None = None,
    order_ids_unique: bool = False,
) -> DataFrame:
    """Lifetime activity, revenue, recency and fulfilment per customer.

    The months of a customer are collected as a set, which holds one entry a month however many orders there are.
    """
    m = _order_measures(order_ids_unique)
    first, last = F.min("order_date"), F.max("order_date")
    return silver.groupBy("customer_id").agg(
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        fx.days_between(first, last).alias("customer_tenure_days"),
        m["orders"].alias("lifetime_order_count"),
        F.size(F.collect_set(F.trunc("order_date", "month"))).cast("long").alias("active_months"),
        m["gross"].alias("lifetime_gross_revenue"),
        m["net"].alias("lifetime_net_revenue"),
        m["avg_order_value"].alias("avg_order_value"),
        F.max("net_revenue").alias("max_single_order"),
        m["discounts"].alias("total_discounts_received"),
        fx.days_between(last, fx.as_date(as_of)).alias("days_since_last_order"),
        m["avg_days_to_ship"].alias("avg_days_to_ship"),
        m["on_time"].alias("pct_orders_on_time"),
    )


def rfm_rankings(recency_direction: str = "as_written") -> list[Ranking]:
    """Quintiles by recency, frequency and monetary value, ties cut by customer_id.

    ``as_written`` ranks days since the last order ascending, so the most recent customers score 1;
    ``most_recent_high`` turns that round.
    """
    if recency_direction not in ("as_written", "most_recent_high"):
        raise ValueError(f"unknown recency_direction {recency_direction!r}")
    return [
        Ranking("recency_score", "days_since_last_order", recency_direction == "most_recent_high"),
        Ranking("frequency_score", "lifetime_order_count"),
        Ranking("monetary_score", "lifetime_net_revenue"),
    ]


def with_rfm(
    metrics: DataFrame, recency_direction: str = "as_written", scores: Sequence[str] = RFM_SCORES
) -> DataFrame:
    """Add the three scores, or some of them. ``metrics`` is read several times, so it should be a stored table."""
    rankings = [r for r in rfm_rankings(recency_direction) if r.name in scores]
    return add_ntiles(metrics, "customer_id", rankings, TILES)


def rfm(
    metrics: DataFrame, recency_direction: str = "as_written", scores: Sequence[str] = RFM_SCORES
) -> DataFrame:
    return with_rfm(metrics, recency_direction, scores).select("customer_id", *scores)


def mart_customer_360(
    silver: DataFrame,
    customers: DataFrame,
    as_of: Column | dt.date | str | None = None,
    recency_direction: str = "as_written",
    refreshed_at: Column | dt.datetime | str | None = None,
    order_ids_unique: bool = False,
) -> DataFrame:
    """One row per customer; a customer without orders has NULL metrics and scores."""
    metrics = customer_metrics(silver, as_of, order_ids_unique)
    return customer_360_of(metrics, customers, recency_direction, refreshed_at)


def customer_360_of(
    metrics: DataFrame,
    customers: DataFrame,
    recency_direction: str = "as_written",
    refreshed_at: Column | dt.datetime | str | None = None,
) -> DataFrame:
    """The mart from the metrics of those customers who have orders."""
    stored = materialize(metrics, "customer-metrics")
    scored = with_rfm(stored, recency_direction)
    metric_columns = [c for c in stored.columns if c != "customer_id"]
    return customers.join(scored, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "email",
        "customer_segment",
        "country",
        "city",
        "signup_date",
        "account_manager",
        "is_active",
        *metric_columns,
        "recency_score",
        "frequency_score",
        "monetary_score",
        rfm_total().alias("rfm_total"),
        fx.churn_risk().alias("churn_risk"),
        fx.customer_tier().alias("customer_tier"),
        fx.as_timestamp(refreshed_at, "timestamp").alias("_refreshed_at"),
    )


def rfm_total() -> Column:
    """Sum of the three scores, NULL if any is NULL."""
    return F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
