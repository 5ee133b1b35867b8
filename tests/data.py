"""Small literal orders and customers, typed as the bronze models."""

from __future__ import annotations

import datetime as dt

from stratum import schemas
from stratum.plans import bronze


def order(order_id="A", **changes):
    row = {
        "order_id": order_id,
        "customer_id": "C1",
        "product_id": "P1",
        "order_date": "2024-01-10",
        "shipped_date": "2024-01-11",
        "quantity": "2",
        "unit_price": "10.00",
        "discount_pct": "0",
        "status": "delivered",
        "region": "North",
        "channel": "online",
        "_loaded_at": "2024-01-12T06:00:00",
        "_source_file": "orders.json",
    }
    return row | changes


def customer(customer_id="C1", **changes):
    row = {
        "customer_id": customer_id,
        "customer_name": f"Name {customer_id}",
        "email": f"{customer_id}@example.com",
        "country": "FR",
        "city": "Paris",
        "customer_segment": "SMB",
        "signup_date": "2023-01-01",
        "is_active": "true",
        "account_manager": "O'Hara",
        "_loaded_at": "2024-01-01T00:00:00",
    }
    return row | changes


def raw(spark, rows, types):
    return spark.createDataFrame([tuple(r[c] for c in types) for r in rows], schemas.text_struct(types))


def orders(spark, *rows):
    return bronze.stg_orders(raw(spark, rows, schemas.ORDER_TYPES))


def customers(spark, *rows):
    return bronze.stg_customers(raw(spark, rows, schemas.CUSTOMER_TYPES))


def day(text):
    return dt.date.fromisoformat(text)
