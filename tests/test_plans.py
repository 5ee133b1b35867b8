"""What the plans must and must not contain to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stratum import schemas
from stratum.operators import checks
from stratum.plans import gold
from stratum.plans.check_catalog import CATALOG
from stratum.registry import spark_queries
from stratum.sources import scratch
from stratum.sources.layers import cluster_interleaved
from tests.conftest import SF_DIR
from tests.data import customer, customers


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "stg_orders",
        "stg_customers",
        "int_orders_enriched",
        "int_orders_incremental",
        "mart_revenue_by_segment",
        "mart_customer_360",
        "agg_customer_metrics",
        "window_ntile_frequency",
        "join_rfm_left",
        "check_unique",
        "check_relationships",
        "dq_suite_bronze",
    ],
)
def test_no_cross_join_no_python_and_no_window_over_everything(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert forbidden not in plan
    for window in re.findall(r"windowspecdefinition\(([^()]*)", plan):
        assert not re.match(r"\S+ (ASC|DESC)", window), "a window without PARTITION BY"


@pytest.fixture
def stored_silver(spark):
    return scratch.materialize(spark_queries.enriched(spark, SF_DIR), "silver")


def test_mart_reads_only_its_columns_and_pushes_its_filter(spark, stored_silver):
    plan = plan_of(gold.mart_revenue_by_segment(stored_silver, "1996-01-01", order_ids_unique=True))
    assert "GreaterThanOrEqual(order_date,1996-01-01)" in plan
    for unread in ("customer_name", "product_id", "unit_price", "order_quarter"):
        assert unread not in plan


@pytest.mark.parametrize("unique", [True, False])
def test_distinct_counts_multiply_no_rows(spark, stored_silver, unique):
    assert "Expand" not in plan_of(gold.mart_revenue_by_segment(stored_silver, order_ids_unique=unique))
    assert "Expand" not in plan_of(gold.customer_metrics(stored_silver, "2001-09-30", order_ids_unique=unique))


@pytest.mark.parametrize(
    "name", ["mart_revenue_by_segment", "mart_customer_360", "agg_monthly_segment", "agg_customer_metrics"]
)
def test_registered_distinct_counts_multiply_no_rows(spark, name):
    assert "Expand" not in plan_of(queries()[name](spark, SF_DIR))


def test_customers_are_counted_from_their_own_columns(spark, stored_silver):
    plan = plan_of(gold.monthly_segment(stored_silver))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(scans) == 2 and any("customer_id" in s and "net_revenue" not in s for s in scans)


def test_a_score_reads_and_ranks_its_metric_only(spark):
    plan = plan_of(queries()["window_ntile_monetary"](spark, SF_DIR))
    assert "lifetime_net_revenue" in plan and "days_since_last_order" not in plan


def test_suite_scans_the_table_once_for_all_row_checks(spark, stored_silver):
    parents = {"stg_customers": customers(spark, customer())}
    suite = checks.run_suite(stored_silver, "m", CATALOG["int_orders_enriched"], parents)
    # One scan for the row checks, one each for uniqueness and relationships.
    assert plan_of(suite).count("FileScan parquet") == 3


def test_silver_schema_is_declared(spark, stored_silver):
    assert stored_silver.schema == schemas.struct(schemas.SILVER_TYPES)


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.new_folder(spark, "x").startswith(f"{shared}/stratum/")
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")


def test_scratch_without_a_shared_folder():
    def session(where):
        class Unset:
            class conf:
                get = staticmethod(lambda key, default: default)

            class sparkContext:
                applicationId = "app"
                master = where

        return Unset

    assert scratch.scratch_root(session("local[2]")) == scratch.scratch_root(session("local"))
    for where in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.scratch_root(session(where))


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    assert "Exchange" not in plan_of(queries()["join_bucketed_left"](spark, SF_DIR))


def test_a_start_found_by_a_query_prunes_months_at_run_time(spark):
    setting = "spark.sql.maxMetadataStringLength"
    spark.conf.set(setting, "2000")
    try:
        plan = plan_of(queries()["filter_start_subquery"](spark, SF_DIR))
    finally:
        spark.conf.unset(setting)
    pruned = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan) if "order_month" in f]
    assert pruned and all(re.search(r"order_month#\d+ >= trunc\(Subquery", f) for f in pruned)


def test_interleaved_files_are_skipped_by_either_column(spark):
    names = ("order_date", "region")
    rows = spark.range(20_000).select(
        F.expr("date_add(date'2024-01-01', cast(id % 31 as int))").alias("order_date"),
        F.element_at(F.array(*map(F.lit, ["East", "North", "South", "West"])), (F.col("id") % 4 + 1).cast("int")).alias("region"),
        F.col("id").cast("string").alias("order_id"),
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # would join these few rows again
    spark.conf.set(setting, "false")
    try:
        laid = cluster_interleaved(rows, names, ["order_id"]).withColumn("part", F.spark_partition_id())
        bounds = laid.groupBy("part").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]).collect()
    finally:
        spark.conf.unset(setting)
    assert len(bounds) == 8 and sum(r["min_region"] <= "East" for r in bounds) <= 4
    assert sum(str(r["min_order_date"]) <= "2024-01-03" for r in bounds) <= 4
