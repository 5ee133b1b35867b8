"""Bronze, silver and gold on small literal tables."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from stratum import schemas
from stratum.plans import bronze, gold, silver
from stratum.plans.check_catalog import CATALOG
from tests.data import customer, customers, day, order, orders, raw

NOW = "2024-06-01 00:00:00"


def silver_rows(spark, order_rows, customer_rows=(), **kwargs):
    return silver.int_orders_enriched(
        orders(spark, *order_rows), customers(spark, *(customer_rows or [customer()])), NOW, **kwargs
    )


def test_schemas(spark):
    rows = silver_rows(spark, [order()])
    assert {f.name: f.dataType.simpleString() for f in rows.schema} == schemas.SILVER_TYPES
    assert len(schemas.SILVER_TYPES) == 28 and list(rows.columns) == list(schemas.SILVER_TYPES)
    assert len(gold.mart_revenue_by_segment(rows).columns) == 17
    assert len(gold.mart_customer_360(rows, customers(spark, customer()), "2024-06-01").columns) == 29


@pytest.mark.parametrize(
    "change", [{"order_date": "soon"}, {"quantity": "two"}, {"unit_price": "123456789012"}, {"order_date": ""}]
)
def test_bronze_refuses_values_that_do_not_fit(spark, change):
    with pytest.raises(PySparkException):
        orders(spark, order(**change)).collect()


def test_bronze_refuses_a_missing_column(spark):
    with pytest.raises(PySparkException):
        bronze.stg_orders(raw(spark, [order()], schemas.ORDER_TYPES).drop("channel"))


def test_silver_keeps_only_valid_orders(spark):
    rows = silver_rows(
        spark,
        [
            order("ok"),
            order("free", unit_price="0"),
            order("none", quantity="0"),
            order("nobody", customer_id=None),
            order("unpriced", unit_price=None),
        ],
    )
    assert {r["order_id"]: r["net_revenue"] for r in rows.collect()} == {"ok": Decimal("20"), "unpriced": None}


def test_silver_values(spark):
    row = silver_rows(spark, [order(quantity="3", unit_price="9.99", discount_pct="12.5")]).first()
    assert row["gross_revenue"] == Decimal("29.97")
    assert row["net_revenue"] == Decimal("26.223750")
    assert row["discount_amount"] == Decimal("3.746250")
    assert (row["days_to_ship"], row["shipped_on_time"]) == (1, True)
    assert (row["order_month"], row["order_quarter"]) == (day("2024-01-01"), day("2024-01-01"))
    assert (row["order_year"], row["order_dow"]) == (2024, 3)
    assert (row["customer_name"], row["account_manager"]) == ("Name C1", "O'Hara")


@pytest.mark.parametrize("broadcast", [True, False])
def test_unknown_customer_leaves_attributes_null(spark, broadcast):
    rows = silver_rows(spark, [order("A"), order("B", customer_id="C9")], broadcast_customers=broadcast)
    assert {r["order_id"]: r["customer_segment"] for r in rows.collect()} == {"A": "SMB", "B": None}


def test_cancelled_and_returned_orders_count_as_revenue(spark):
    rows = silver_rows(spark, [order("A", status="cancelled"), order("B", status="returned")])
    assert gold.mart_revenue_by_segment(rows).first()["net_revenue"] == Decimal("40")


def test_growth_against_the_previous_present_month(spark):
    def in_month(month, price, discount="0"):
        return order(month, order_date=f"2024-{month}-05", shipped_date=None, unit_price=price, discount_pct=discount)

    rows = silver_rows(
        spark, [in_month("01", "10"), in_month("02", "15", "100"), in_month("04", "30"), in_month("05", "15")]
    )
    mart = [
        (
            r["order_month"].month,
            r["net_revenue"],
            r["prev_month_revenue"],
            r["revenue_mom_delta"],
            r["revenue_mom_growth_pct"],
        )
        for r in gold.mart_revenue_by_segment(rows).collect()
    ]
    assert mart == [  # newest first; March is missing, and growth from zero is unknown
        (5, Decimal(30), Decimal(60), Decimal(-30), -50.0),
        (4, Decimal(60), Decimal(0), Decimal(60), None),
        (2, Decimal(0), Decimal(20), Decimal(-20), -100.0),
        (1, Decimal(20), None, None, None),
    ]


def test_revenue_mart_groups_orders_without_segment(spark):
    rows = silver_rows(spark, [order("A"), order("B", customer_id="C9"), order("C", customer_id="C9")])
    mart = {r["customer_segment"]: r for r in gold.mart_revenue_by_segment(rows).collect()}
    assert mart[None]["order_count"] == 2 and mart[None]["unique_customers"] == 1
    assert mart["SMB"]["order_count"] == 1


def test_revenue_mart_starts_at_its_date(spark):
    rows = silver_rows(spark, [order("A", order_date="2022-12-31"), order("B", order_date="2023-01-01")])
    assert [r["order_month"] for r in gold.mart_revenue_by_segment(rows).collect()] == [day("2023-01-01")]


def test_unshipped_orders_lower_the_on_time_share(spark):
    rows = silver_rows(spark, [order("A"), order("B", shipped_date=None)])
    row = gold.mart_revenue_by_segment(rows).first()
    assert row["on_time_delivery_pct"] == 50.0 and row["avg_days_to_ship"] == 1.0


@pytest.mark.parametrize("unique, count", [(False, 1), (True, 2)])
def test_repeated_order_ids_are_counted_once_unless_declared_unique(spark, unique, count):
    rows = silver_rows(spark, [order("A"), order("A")])
    assert gold.mart_revenue_by_segment(rows, order_ids_unique=unique).first()["order_count"] == count
    assert gold.customer_metrics(rows, "2024-06-01", unique).first()["lifetime_order_count"] == count


def test_customer_360(spark):
    people = [customer("C1"), customer("C2")]
    rows = silver_rows(
        spark,
        [order("A", quantity="1000"), order("B", order_date="2024-03-01", shipped_date=None)],
        people,
    )
    marts = gold.mart_customer_360(rows, customers(spark, *people), "2024-06-01")
    mart = {r["customer_id"]: r for r in marts.collect()}
    first, idle = mart["C1"], mart["C2"]
    assert first["customer_tenure_days"] == 51 and first["active_months"] == 2
    assert first["days_since_last_order"] == 92 and first["churn_risk"] == "medium"
    assert first["lifetime_net_revenue"] == Decimal("10020") and first["customer_tier"] == "Silver"
    assert first["avg_order_value"] == 5010.0 and first["max_single_order"] == Decimal("10000")
    assert first["rfm_total"] == 3
    # A customer without orders has no metrics and no scores, and falls into the last branches.
    assert idle["lifetime_order_count"] is None and idle["rfm_total"] is None
    assert (idle["churn_risk"], idle["customer_tier"]) == ("low", "Bronze")


def test_recency_direction(spark):
    people = [customer(f"C{i}") for i in range(5)]
    rows = silver_rows(
        spark, [order(f"O{i}", customer_id=f"C{i}", order_date=f"2024-0{i + 1}-01") for i in range(5)], people
    )

    def recency(direction):
        mart = gold.mart_customer_360(rows, customers(spark, *people), "2024-06-01", direction)
        return [r["recency_score"] for r in mart.orderBy("customer_id").collect()]

    assert recency("as_written") == [5, 4, 3, 2, 1]
    assert recency("most_recent_high") == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        recency("newest")


def test_catalog_is_complete():
    assert {model: len(checks) for model, checks in CATALOG.items()} == {
        "raw_orders": 4,
        "raw_customers": 4,
        "stg_orders": 17,
        "stg_customers": 10,
        "int_orders_enriched": 17,
        "mart_revenue_by_segment": 12,
        "mart_customer_360": 21,
    }
    kinds = [c.kind for checks in CATALOG.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 9,
        "not_null": 45,
        "accepted_range": 20,
        "accepted_values": 10,
        "relationships": 1,
    }
