import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratum import functions as fx
from tests.data import day


def one(spark, value, kind, make):
    """Value of an expression over a one-row column ``x``."""
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "n, d, expected", [(1, 4, 0.25), (1, 0, None), (1, None, None), (None, 2, None), (-3, 2, -1.5)]
)
def test_safe_divide(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n int, d int")
    assert df.select(fx.safe_divide("n", "d")).first()[0] == expected


def test_safe_divide_of_a_sum_divides_the_whole_sum(spark):
    df = spark.createDataFrame([(1, 3)], "a int, b int")
    assert df.select(fx.safe_divide(F.col("a") + F.col("b"), F.lit(2))).first()[0] == 2.0


@pytest.mark.parametrize(
    "revenue, band",
    [
        ("999.99", "< $1K"),
        ("1000", "$1K–$10K"),
        ("9999.99", "$1K–$10K"),
        ("10000", "$10K–$100K"),
        ("99999.99", "$10K–$100K"),
        ("100000", "> $100K"),
        (None, "> $100K"),
    ],
)
def test_revenue_bands(spark, revenue, band):
    assert one(spark, revenue and Decimal(revenue), "decimal(12,2)", fx.revenue_bands) == band


@pytest.mark.parametrize(
    "revenue, tier",
    [
        ("5000", "Bronze"),
        ("5000.01", "Silver"),
        ("25000", "Silver"),
        ("25000.01", "Gold"),
        ("100000", "Gold"),
        ("100000.01", "Platinum"),
        (None, "Bronze"),
    ],
)
def test_customer_tier(spark, revenue, tier):
    assert one(spark, revenue and Decimal(revenue), "decimal(12,2)", fx.customer_tier) == tier


@pytest.mark.parametrize(
    "days, risk", [(90, "low"), (91, "medium"), (180, "medium"), (181, "high"), (None, "low")]
)
def test_churn_risk(spark, days, risk):
    assert one(spark, days, "int", fx.churn_risk) == risk


@pytest.mark.parametrize(
    "shipped, on_time",
    [("2024-01-12", True), ("2024-01-13", False), (None, False), ("2024-01-09", True)],
)
def test_shipped_on_time(spark, shipped, on_time):
    df = spark.createDataFrame([(day("2024-01-10"), shipped and day(shipped))], "order_date date, shipped_date date")
    assert df.select(fx.shipped_on_time()).first()[0] is on_time


@pytest.mark.parametrize(
    "price, quantity, customer, flag",
    [
        ("0", 1, "C", "invalid_price"),
        ("-1", 0, None, "invalid_price"),
        ("1", 0, None, "invalid_quantity"),
        ("1", 1, None, "missing_customer"),
        ("1", 1, "C", "ok"),
        (None, 1, "C", "ok"),
        (None, 0, "C", "invalid_quantity"),
        ("1", None, "C", "ok"),
    ],
)
def test_dq_flag_takes_the_first_fault(spark, price, quantity, customer, flag):
    df = spark.createDataFrame(
        [(price and Decimal(price), quantity, customer)],
        "unit_price decimal(10,2), quantity int, customer_id string",
    )
    assert df.select(fx.dq_flag()).first()[0] == flag


def test_revenue_is_exact_for_the_widest_values(spark):
    df = spark.createDataFrame(
        [(2**31 - 1, Decimal("99999999.99"), Decimal("33.33"))],
        "quantity int, unit_price decimal(10,2), discount_pct decimal(5,2)",
    )
    row = df.select(fx.gross_revenue(), fx.net_revenue(), fx.discount_amount()).first()
    gross = (2**31 - 1) * Decimal("99999999.99")
    assert row[0] == gross
    assert row[1] == gross * Decimal("0.6667")
    assert row[2] == gross * Decimal("0.3333")


def test_hours_are_counted_by_boundaries(spark):
    df = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 2, 1)),
            (dt.datetime(2024, 1, 1, 1, 0), dt.datetime(2024, 1, 1, 1, 59)),
            (dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1, 0, 0)),
            (dt.datetime(1969, 12, 31, 23, 30), dt.datetime(1970, 1, 1, 0, 30)),
            (dt.datetime(2024, 1, 1, 5, 0), dt.datetime(2024, 1, 1, 4, 59)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(fx.hours_between("a", "b")).collect()] == [2, 0, 1, 1, -1]


def test_date_dims(spark):
    dims = fx.date_dims("x")
    df = spark.createDataFrame([(day("2024-05-19"),), (day("2024-05-25"),)], "x date")
    sunday, saturday = df.select(*[c.alias(n) for n, c in dims.items()]).collect()
    assert tuple(sunday) == (day("2024-05-01"), day("2024-04-01"), 2024, 0)
    assert saturday["order_dow"] == 6


@pytest.mark.parametrize(
    "fields, text", [(("a", "b"), "a|b"), (("a", None), ""), ((None, None), ""), (("", ""), "|")]
)
def test_surrogate_key(spark, fields, text):
    df = spark.createDataFrame([fields], "a string, b string")
    assert df.select(fx.surrogate_key("a", "b")).first()[0] == hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_can_replace_null_field_by_field(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    key = df.select(fx.surrogate_key("a", "b", null_as="-")).first()[0]
    assert key == hashlib.md5(b"a|-").hexdigest()


def spine(spark, *args, **kwargs):
    return sorted(r[0].isoformat() for r in fx.date_spine(spark, *args, **kwargs).collect())


def test_spine_includes_both_ends(spark):
    assert spine(spark, "2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert spine(spark, "2024-01-01", "2024-01-01") == ["2024-01-01"]
    assert spine(spark, "2024-01-02", "2024-01-01") == []


def test_spine_of_months_from_the_31st(spark):
    assert spine(spark, "2024-01-31", "2024-05-30", "month") == [
        "2024-01-31",
        "2024-02-29",
        "2024-03-31",
        "2024-04-30",
    ]
    assert spine(spark, "2024-01-31", "2024-02-28", "month") == ["2024-01-31"]
    assert spine(spark, "2024-01-31", "2024-02-29", "month") == ["2024-01-31", "2024-02-29"]


def test_spine_of_other_parts(spark):
    assert spine(spark, "2024-01-01", "2024-01-15", "week") == ["2024-01-01", "2024-01-08", "2024-01-15"]
    assert spine(spark, "2024-01-01", "2024-07-01", "quarter") == ["2024-01-01", "2024-04-01", "2024-07-01"]
    assert spine(spark, "2022-01-01", "2024-01-01", "year") == ["2022-01-01", "2023-01-01", "2024-01-01"]


def test_spine_stops_only_after_steps_asked_for(spark):
    assert len(spine(spark, "2000-01-01", "2020-12-31")) == 7671
    assert len(spine(spark, "2000-01-01", "2020-01-01", max_steps=10000)) == 7306
