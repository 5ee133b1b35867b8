"""Bronze: typed views over the raw feeds, one row per raw row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.schemas import CUSTOMER_TYPES, ORDER_TYPES
from stratum.sources.layers import create_catalog_view


def typed(raw: DataFrame, types: dict[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Cast each declared column; a missing column or a value that does not fit its type raises."""
    wanted = columns or types
    return raw.select(*[F.col(name).cast(types[name]).alias(name) for name in wanted])


def stg_orders(raw: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return typed(raw, ORDER_TYPES, columns)


def stg_customers(raw: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return typed(raw, CUSTOMER_TYPES, columns)


def publish_views(
    spark: SparkSession, orders_table: str, customers_table: str, database_prefix: str = ""
) -> list[str]:
    """Both models as views of the bronze database over catalog tables; nothing is stored."""
    return [
        create_catalog_view(
            spark,
            "bronze",
            model,
            [f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in types.items()],
            table,
            database_prefix,
        )
        for model, table, types in (
            ("stg_orders", orders_table, ORDER_TYPES),
            ("stg_customers", customers_table, CUSTOMER_TYPES),
        )
    ]
