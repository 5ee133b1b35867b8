"""The given order tables (lineitem, orders, customer, part, nation, region) as the two raw feeds.

One raw order is one order line; every line is one. Dimension columns are attached by left joins on unique keys, so leaving a
join out never changes the rows; a caller that names the columns it needs gets only the joins for those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.schemas import CUSTOMER_TYPES, ORDER_TYPES

# How the given codes map onto the feed's domains.
REGIONS = {
    "AMERICA": "West",
    "EUROPE": "North",
    "ASIA": "East",
    "AFRICA": "South",
    "MIDDLE EAST": "International",
}
CHANNELS = {"1": "direct", "2": "partner", "3": "retail", "4": "online", "5": "online"}
SEGMENTS = {
    "MACHINERY": "Enterprise",
    "AUTOMOBILE": "Enterprise",
    "BUILDING": "SMB",
    "FURNITURE": "SMB",
    "HOUSEHOLD": "Consumer",
}

SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

_FROM_ORDERS = {"customer_id", "order_date", "status", "channel", "_loaded_at", "_source_file", "region"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(column: Column, mapping: dict[str, str]) -> Column:
    out = None
    for value, label in mapping.items():
        out = F.when(column == value, label) if out is None else out.when(column == value, label)
    return out


def line_id() -> Column:
    """What tells all given lines apart: line numbers repeat within an order."""
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    parts = [*keys, F.col("l_shipdate").cast("date").cast("string")]
    return F.concat(*[x for part in parts for x in (F.lit("-"), part)][1:])


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation")
    return nations.join(
        regions, nations.n_regionkey == regions.r_regionkey, "left"
    ).select("n_nationkey", "n_name", "r_name")


def _order_headers(spark: SparkSession, sf_dir: str, with_region: bool) -> DataFrame:
    """Dimensions go onto the order headers first: they are fewer and narrower than the lines."""
    headers = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    if not with_region:
        return headers
    nations = _nations(spark, sf_dir)
    customers = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "r_name")
    )
    return headers.join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "left"
    ).drop("c_custkey")


def raw_orders(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    wanted = list(columns or ORDER_TYPES)
    lines = table(spark, sf_dir, "lineitem")
    # The order's columns come last: they are many, and the shuffle for the parts needn't carry them.
    if "unit_price" in wanted:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if _FROM_ORDERS & set(wanted):
        headers = _order_headers(spark, sf_dir, "region" in wanted)
        lines = lines.join(
            headers, F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )

    price = (
        F.col("p_retailprice").cast("decimal(10,2)") * F.lit("0.1").cast("decimal(2,1)")
    ).cast("decimal(10,2)")
    six_in_the_morning = F.expr("o_orderdate + interval 30 hours")
    expressions = {
        "order_id": line_id(),
        # Some orders name no customer, some one that the customers' feed does not have.
        "customer_id": F.when(F.col("o_custkey") % 83 == 0, None)
        .when(F.col("o_custkey") % 101 == 0, (-F.col("o_custkey")).cast("string"))
        .otherwise(F.col("o_custkey").cast("string")),
        "product_id": F.col("l_partkey").cast("string"),
        "order_date": F.col("o_orderdate").cast("date"),
        "shipped_date": F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date")),
        "quantity": F.when(F.col("l_orderkey") % 97 == 0, F.lit(0)).otherwise(
            F.col("l_quantity").cast("int")
        ),
        "unit_price": F.when(F.col("l_orderkey") % 89 == 0, F.lit(0).cast("decimal(10,2)"))
        .otherwise(price)
        .cast("decimal(10,2)"),
        "discount_pct": (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)"),
        "status": F.when(
            (F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "A"), "cancelled"
        )
        .when(F.col("l_returnflag") == "R", "returned")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "delivered")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "shipped")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "confirmed")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "pending"),
        "region": _lookup(F.col("r_name"), REGIONS),
        "channel": _lookup(F.substring("o_orderpriority", 1, 1), CHANNELS),
        "_loaded_at": six_in_the_morning.cast("timestamp_ntz"),
        "_source_file": F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".json")),
    }
    return lines.select(*[expressions[c].alias(c) for c in wanted])


def raw_customers(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    wanted = list(columns or CUSTOMER_TYPES)
    customers = table(spark, sf_dir, "customer")
    if "country" in wanted:
        customers = customers.join(
            table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
    key = F.col("c_custkey")
    expressions = {
        "customer_id": key.cast("string"),
        "customer_name": F.col("c_name"),
        "email": F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")),
        "country": F.col("n_name"),
        "city": F.concat(F.lit("CITY_"), (key % 13).cast("string")),
        "customer_segment": _lookup(F.col("c_mktsegment"), SEGMENTS),
        "signup_date": F.date_add(F.lit("1992-01-01").cast("date"), (key % 365).cast("int")),
        "is_active": F.col("c_acctbal") >= 0,
        "account_manager": F.concat(F.lit("AM_"), (key % 4).cast("string")),
        "_loaded_at": F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"),
    }
    return customers.select(*[expressions[c].alias(c) for c in wanted])
