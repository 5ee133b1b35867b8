"""Column names and types of the raw feeds, the bronze views and the silver table."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze column types.
ORDER_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "product_id": "string",
    "order_date": "date",
    "shipped_date": "date",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "discount_pct": "decimal(5,2)",
    "status": "string",
    "region": "string",
    "channel": "string",
    "_loaded_at": "timestamp_ntz",
    "_source_file": "string",
}

CUSTOMER_TYPES = {
    "customer_id": "string",
    "customer_name": "string",
    "email": "string",
    "country": "string",
    "city": "string",
    "customer_segment": "string",
    "signup_date": "date",
    "is_active": "boolean",
    "account_manager": "string",
    "_loaded_at": "timestamp_ntz",
}

# Widths that hold every int quantity times every decimal(10,2) price, exactly.
GROSS_TYPE = "decimal(20,2)"
NET_TYPE = "decimal(24,6)"
GROSS_SUM_TYPE = "decimal(38,2)"
NET_SUM_TYPE = "decimal(38,6)"

SILVER_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "product_id": "string",
    "order_date": "date",
    "shipped_date": "date",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "discount_pct": "decimal(5,2)",
    "status": "string",
    "region": "string",
    "channel": "string",
    "gross_revenue": GROSS_TYPE,
    "net_revenue": NET_TYPE,
    "discount_amount": NET_TYPE,
    "days_to_ship": "int",
    "shipped_on_time": "boolean",
    "customer_name": "string",
    "customer_segment": "string",
    "country": "string",
    "city": "string",
    "account_manager": "string",
    "order_month": "date",
    "order_quarter": "date",
    "order_year": "int",
    "order_dow": "int",
    "dq_flag": "string",
    "_loaded_at": "timestamp_ntz",
    "_transformed_at": "timestamp",
}


def struct(types: dict[str, str]) -> T.StructType:
    """All-nullable StructType for a name -> type mapping."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in types.items()))


def text_struct(types: dict[str, str]) -> T.StructType:
    """The same columns as plain strings, for feeds that are typed later in bronze."""
    return T.StructType([T.StructField(name, T.StringType()) for name in types])
