"""Registered queries: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum import schemas
from stratum.operators import checks, upsert
from stratum.operators.joins import left_join
from stratum.plans import bronze, gold, partials, silver
from stratum.plans.check_catalog import CATALOG, SEGMENTS
from stratum.plans.pipeline import PipelineConfig, run_pipeline
from stratum.registry.params import AS_OF, CUT, CUT_TIME, EARLY_CUT_TIME, NOW, START_DATE
from stratum.sources import readers, tpch, versions
from stratum.sources.layers import (
    LAYERS, LayerStore, cluster_interleaved, create_view, replace_table, write_bucketed,
)
from stratum.sources.scratch import dropped_after, materialize, new_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

BUCKETS = 8
_LAYOUT = (schemas.SILVER_TYPES, silver.KEY, "order_month", silver.CLUSTER_BY)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def entry(spark: SparkSession) -> DataFrame:
    return mart_revenue_by_segment(spark, "/root/testdata/sf0.001")


# --- inputs -------------------------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return bronze.stg_orders(tpch.raw_orders(spark, sf_dir, columns or None), columns or None)


def customers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return bronze.stg_customers(tpch.raw_customers(spark, sf_dir, columns or None), columns or None)


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as a stored table, as they are where runs follow one another."""
    return materialize(tpch.raw_orders(spark, sf_dir), "raw-orders")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows without customer attributes, for queries that use none."""
    return silver.clean_orders(orders(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.int_orders_enriched(orders(spark, sf_dir), customers(spark, sf_dir), NOW)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_metrics(clean(spark, sf_dir), AS_OF)


def scores(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Some of the scores, from a stored table of the metrics that they rank and no others."""
    keys = [r.key for r in gold.rfm_rankings() if r.name in names]
    stored = materialize(metrics(spark, sf_dir).select("customer_id", *keys), "customer-metrics")
    return gold.rfm(stored, scores=names)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_segment(enriched(spark, sf_dir))


# --- scans, sources and sinks -------------------------------------------------------------


@query
def scan_raw_orders(spark, sf_dir):
    return tpch.raw_orders(spark, sf_dir)


@query
def scan_raw_customers(spark, sf_dir):
    return tpch.raw_customers(spark, sf_dir)


@query
def csv_roundtrip(spark, sf_dir):
    path = new_folder(spark, "orders-csv")
    tpch.raw_orders(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return bronze.stg_orders(readers.read_csv_seed(spark, path, schemas.ORDER_TYPES))


@query
def json_roundtrip(spark, sf_dir):
    """The orders of each source file landed apart; which file a row came from must tell its source file again."""
    path = new_folder(spark, "orders-json")
    stored = landed_orders(spark, sf_dir)
    for source in [r[0] for r in stored.select("_source_file").distinct().collect()]:  # one a year
        stored.filter(F.col("_source_file").eqNullSafe(source)).write.mode("append").json(path, compression="gzip")
    rows = bronze.stg_orders(readers.read_json_landing(spark, path, schemas.ORDER_TYPES))
    # Files are named by the writer; the orders of one are all of one year, which named the source file.
    year = F.year("order_date")
    files = rows.groupBy("_source_file").agg(F.min(year).alias("first"), F.max(year).alias("last"))
    named = F.when(F.col("first") == F.col("last"), F.concat(F.lit("orders_"), "first", F.lit(".json")))
    # Files are few beside their orders, which needn't move to them.
    files = materialize(files, "landed-files")
    joined = left_join(rows, files, "_source_file", silver.KEY)
    return joined.withColumn("_source_file", named).select(rows.columns)


@query
def json_quarantine(spark, sf_dir):
    """Landed lines of which some are cut off: rows that could be read, and lines that are kept apart."""
    raw = tpch.raw_orders(spark, sf_dir)
    line = F.to_json(F.struct(*raw.columns))
    cut = F.when(F.col("quantity").cast("int") % 10 == 0, F.expr("left(line, length(line) - 9)")).otherwise(F.col("line"))
    path = new_folder(spark, "cut-json")
    raw.select("quantity", line.alias("line")).select(cut.alias("value")).write.text(path, compression="gzip")
    good, bad = readers.split_json_landing(spark, path, schemas.ORDER_TYPES)
    counted = bronze.stg_orders(good).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity")
    )
    kept = bad.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.unionByName(kept.select(F.lit("quarantine").alias("region"), "n_rows"), allowMissingColumns=True)


@query
def view_stg_orders(spark, sf_dir):
    create_view(orders(spark, sf_dir), "stg_orders")
    return spark.sql("SELECT * FROM stg_orders")


@query
def table_full_refresh(spark, sf_dir):
    store = LayerStore(spark, new_folder(spark, "full-refresh"))
    stg = orders(spark, sf_dir)
    store.replace(stg.filter(F.col("order_date") < CUT), "gold", "orders")
    return store.replace(stg.filter(F.col("order_date") >= CUT), "gold", "orders")


@query
def clustered_write(spark, sf_dir):
    path = new_folder(spark, "clustered")
    replace_table(clean(spark, sf_dir), path, silver.CLUSTER_BY, [silver.KEY])
    return versions.read(spark, path)


def _first_silver(stg, people, path):
    """Silver in one go, its rows dealt out as the pipeline's first build does."""
    ranges = upsert.leading("order_month", silver.CLUSTER_BY)
    with dropped_after(stg.sparkSession):
        rows = silver.int_orders_enriched(stg, people, NOW, ranged_by=ranges)
        upsert.full_load(rows, path, *_LAYOUT, ranged=True)


def _silver_up_to_cut(stg, people, path):
    """Silver as a first run would leave it that saw only the orders loaded up to the cut."""
    _first_silver(stg.filter(F.col("_loaded_at") <= F.lit(CUT_TIME).cast("timestamp_ntz")), people, path)


def _late_batch(stg: DataFrame) -> DataFrame:
    """Updates (discount dropped, moved a month) of orders loaded before the cut, and all orders loaded after it."""
    late = stg.filter(F.col("_loaded_at") > F.lit(EARLY_CUT_TIME).cast("timestamp_ntz"))
    updated = F.col("_loaded_at") <= F.lit(CUT_TIME).cast("timestamp_ntz")
    return late.withColumns(
        {
            "discount_pct": F.when(updated, F.lit(0).cast("decimal(5,2)")).otherwise(F.col("discount_pct")),
            "order_date": F.when(updated, F.add_months("order_date", 1)).otherwise(F.col("order_date")),
        }
    )


@query
def merge_upsert(spark, sf_dir):
    """Load up to the cut, then merge a batch of updates (discount dropped, moved a month) and inserts."""
    path = new_folder(spark, "merge")
    with dropped_after(spark):
        stg, people = bronze.stg_orders(landed_orders(spark, sf_dir)), customers(spark, sf_dir)
        _silver_up_to_cut(stg, people, path)
        upsert.upsert(spark, silver.int_orders_enriched(_late_batch(stg), people, NOW), path, *_LAYOUT)
    return versions.read(spark, path, schemas.SILVER_TYPES).drop("_transformed_at")


def _merged_store(spark, sf_dir, label: str) -> LayerStore:
    """Silver merged as in ``merge_upsert``, with the partial sums of gold refreshed before and after."""
    store = LayerStore(spark, new_folder(spark, label))
    path = store.path("silver", "int_orders_enriched")
    with dropped_after(spark):
        stg, people = bronze.stg_orders(landed_orders(spark, sf_dir)), customers(spark, sf_dir)
        _silver_up_to_cut(stg, people, path)
        partials.refresh(store, "int_orders_enriched")
        upsert.upsert(spark, silver.int_orders_enriched(_late_batch(stg), people, NOW), path, *_LAYOUT)
    partials.refresh(store, "int_orders_enriched")
    return store


@query
def mart_revenue_incremental(spark, sf_dir):
    """The revenue mart after a merge, from stored months of which only the changed ones were made anew."""
    return partials.mart_revenue_by_segment(_merged_store(spark, sf_dir, "revenue-partials"), START_DATE)


@query
def mart_customer_360_incremental(spark, sf_dir):
    store = _merged_store(spark, sf_dir, "customer-partials")
    metrics = partials.customer_metrics(store, AS_OF)
    return gold.customer_360_of(metrics, customers(spark, sf_dir), refreshed_at=NOW).drop("_refreshed_at")


@query
def incremental_watermark(spark, sf_dir):
    seen = orders(spark, sf_dir, "order_date", "_loaded_at").filter(F.col("order_date") < CUT)
    mark = upsert.high_water_mark(seen)
    return upsert.newer_than(orders(spark, sf_dir), mark)


def _digest(columns) -> Column:
    """128 bits of the columns as text, each with its length, so that different rows have different ones."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])))


@query
def full_vs_incremental_equiv(spark, sf_dir):
    """Silver built in one go against silver built up to the cut and then merged: rows that differ."""
    path, in_one_go = new_folder(spark, "incremental"), new_folder(spark, "in-one-go")
    # Only the key and a digest of all other columns move to be compared.
    row = _digest([c for c in schemas.SILVER_TYPES if c != "_transformed_at"]).alias("row")
    with dropped_after(spark):
        stg, people = bronze.stg_orders(landed_orders(spark, sf_dir)), customers(spark, sf_dir)
        _silver_up_to_cut(stg, people, path)
        new_orders = upsert.newer_than(stg, versions.current(spark, path).newest)
        upsert.upsert(spark, silver.int_orders_enriched(new_orders, people, NOW), path, *_LAYOUT)
        full = silver.int_orders_enriched(stg, people, NOW).select(F.col("order_id"), row)
        full = materialize(full, "in-one-go", in_one_go)

    merged = versions.read(spark, path, schemas.SILVER_TYPES).select(F.col("order_id"), row)
    both = full.alias("f").join(merged.alias("i"), "order_id", "full_outer")
    return both.agg(
        F.count("f.row").alias("rows_full"),
        F.count("i.row").alias("rows_incremental"),
        F.count_if(~F.col("f.row").eqNullSafe(F.col("i.row"))).alias("rows_differing"),
    )


# --- projections, casts and filters -------------------------------------------------------


@query
def project_alias(spark, sf_dir):
    return orders(spark, sf_dir, "order_id", "product_id", "quantity").select(
        F.col("order_id").alias("id"), F.col("product_id").alias("product"), (F.col("quantity") * 2).alias("doubled")
    )


@query
def cast_types(spark, sf_dir):
    """Every declared cast, from text."""
    raw = tpch.raw_orders(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return bronze.stg_orders(text).select(
        "order_id",
        "order_date",
        "shipped_date",
        "quantity",
        "unit_price",
        "discount_pct",
        "_loaded_at",
        F.col("quantity").cast("double").alias("quantity_float"),
        (F.col("quantity") % 2 == 1).cast("string").cast("boolean").alias("is_odd"),
    )


@query
def filter_dq_ok(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def filter_start_date(spark, sf_dir):
    return orders(spark, sf_dir).filter(F.col("order_date") >= fx.as_date(START_DATE))


@query
def filter_scalar_subquery(spark, sf_dir):
    stg = orders(spark, sf_dir, "order_id", "order_date", "_loaded_at")
    seen = stg.filter(F.col("order_date") < CUT).agg(F.max("_loaded_at"))
    return stg.filter(F.col("_loaded_at") > seen.scalar())


@query
def having_null_pct(spark, sf_dir):
    return checks.null_share_above(orders(spark, sf_dir, "shipped_date"), "shipped_date", 0.75)


@query
def having_stale(spark, sf_dir):
    return checks.stale(orders(spark, sf_dir, "_loaded_at"), "_loaded_at", 5, NOW)


# --- joins --------------------------------------------------------------------------------


@query
def join_enrich_left(spark, sf_dir):
    return enriched(spark, sf_dir).select("order_id", "customer_id", *silver.CUSTOMER_COLUMNS)


@query
def join_customer_metrics_left(spark, sf_dir):
    return customers(spark, sf_dir).select("customer_id", "customer_name").join(
        metrics(spark, sf_dir), "customer_id", "left"
    )


@query
def join_rfm_left(spark, sf_dir):
    return customers(spark, sf_dir).select("customer_id", "customer_name").join(
        scores(spark, sf_dir, *gold.RFM_SCORES), "customer_id", "left"
    )


# --- aggregations -------------------------------------------------------------------------


@query
def agg_monthly_segment(spark, sf_dir):
    return monthly(spark, sf_dir)


@query
def agg_customer_metrics(spark, sf_dir):
    return metrics(spark, sf_dir)


@query
def agg_count_star(spark, sf_dir):
    return orders(spark, sf_dir, "status").groupBy("status").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def agg_count_distinct(spark, sf_dir):
    return (
        orders(spark, sf_dir, "channel", "customer_id")
        .groupBy("channel")
        .agg(F.countDistinct("customer_id").alias("unique_customers"))
    )


@query
def agg_count_distinct_expr(spark, sf_dir):
    return (
        orders(spark, sf_dir, "customer_id", "order_date")
        .groupBy("customer_id")
        .agg(F.countDistinct(F.trunc("order_date", "month")).alias("active_months"))
    )


@query
def agg_sum_int(spark, sf_dir):
    return (
        orders(spark, sf_dir, "product_id", "quantity")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("total_units"))
    )


@query
def agg_sum_decimal(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return rows.groupBy("order_year", "region").agg(
        F.sum("gross_revenue").cast(schemas.GROSS_SUM_TYPE).alias("gross_revenue"),
        F.sum("net_revenue").cast(schemas.NET_SUM_TYPE).alias("net_revenue"),
        F.sum("discount_amount").cast(schemas.NET_SUM_TYPE).alias("total_discounts"),
    )


@query
def agg_avg_decimal(spark, sf_dir):
    total = F.sum("net_revenue").cast(schemas.NET_SUM_TYPE)
    return (
        clean(spark, sf_dir)
        .groupBy("channel")
        .agg(fx.safe_divide(total, F.count("net_revenue")).alias("avg_order_value"))
    )


@query
def agg_avg_int(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("channel").agg(F.avg("days_to_ship").alias("avg_days_to_ship"))


@query
def agg_min_max_date(spark, sf_dir):
    return (
        orders(spark, sf_dir, "customer_id", "order_date")
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    )


@query
def agg_max_decimal(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("customer_id").agg(F.max("net_revenue").alias("max_single_order"))


@query
def agg_conditional_sum(spark, sf_dir):
    on_time = F.when(F.col("shipped_on_time"), 1).otherwise(0)
    return clean(spark, sf_dir).groupBy("channel").agg(F.sum(on_time).alias("orders_on_time"))


@query
def agg_count_if(spark, sf_dir):
    return (
        orders(spark, sf_dir, "status", "shipped_date")
        .groupBy("status")
        .agg(F.count_if(F.col("shipped_date").isNull()).alias("unshipped"))
    )


@query
def agg_on_time_pct(spark, sf_dir):
    on_time = F.sum(F.when(F.col("shipped_on_time"), 1).otherwise(0))
    return (
        clean(spark, sf_dir)
        .groupBy("region", "channel")
        .agg(fx.percent(on_time, F.count(F.lit(1))).alias("on_time_delivery_pct"))
    )


@query
def agg_tenure_recency(spark, sf_dir):
    first, last = F.min("order_date"), F.max("order_date")
    return (
        orders(spark, sf_dir, "customer_id", "order_date")
        .groupBy("customer_id")
        .agg(
            fx.days_between(first, last).alias("customer_tenure_days"),
            fx.days_between(last, fx.as_date(AS_OF)).alias("days_since_last_order"),
        )
    )


# --- windows and sort ---------------------------------------------------------------------

_MONTH_KEYS = ("order_month", "customer_segment", "region", "channel")


@query
def window_lag_prev_month(spark, sf_dir):
    return gold.with_month_over_month(monthly(spark, sf_dir)).select(
        *_MONTH_KEYS, "net_revenue", "prev_month_revenue"
    )


@query
def window_mom_delta(spark, sf_dir):
    return gold.with_month_over_month(monthly(spark, sf_dir)).select(*_MONTH_KEYS, "revenue_mom_delta")


@query
def window_mom_growth_pct(spark, sf_dir):
    return gold.with_month_over_month(monthly(spark, sf_dir)).select(*_MONTH_KEYS, "revenue_mom_growth_pct")


@query
def window_ntile_recency(spark, sf_dir):
    return scores(spark, sf_dir, "recency_score")


@query
def window_ntile_frequency(spark, sf_dir):
    return scores(spark, sf_dir, "frequency_score")


@query
def window_ntile_monetary(spark, sf_dir):
    return scores(spark, sf_dir, "monetary_score")


@query
def sort_month_revenue_desc(spark, sf_dir):
    return (
        monthly(spark, sf_dir)
        .select(*_MONTH_KEYS, "net_revenue")
        .orderBy(F.desc_nulls_first("order_month"), F.desc_nulls_first("net_revenue"))
    )


# --- expressions --------------------------------------------------------------------------


@query
def calc_revenue(spark, sf_dir):
    return orders(spark, sf_dir, "order_id", "quantity", "unit_price", "discount_pct").select(
        "order_id",
        fx.gross_revenue().alias("gross_revenue"),
        fx.net_revenue().alias("net_revenue"),
        fx.discount_amount().alias("discount_amount"),
    )


@query
def shipped_on_time(spark, sf_dir):
    return orders(spark, sf_dir, "order_id", "order_date", "shipped_date").select(
        "order_id", fx.shipped_on_time().alias("shipped_on_time")
    )


@query
def dq_flag(spark, sf_dir):
    return orders(spark, sf_dir, "order_id", "unit_price", "quantity", "customer_id").select(
        "order_id", fx.dq_flag().alias("dq_flag")
    )


@query
def days_to_ship(spark, sf_dir):
    return orders(spark, sf_dir, "order_id", "order_date", "shipped_date").select(
        "order_id", fx.days_between("order_date", "shipped_date").alias("days_to_ship")
    )


@query
def datediff_hour(spark, sf_dir):
    """Hour boundaries between each line's shipping time, put off by some minutes, and its load time."""
    shipped = F.timestamp_add("MINUTE", F.col("l_orderkey") % 1440, F.col("shipped_date").cast("timestamp_ntz"))
    rows = orders(spark, sf_dir, "order_id", "shipped_date", "_loaded_at")
    minutes = rows.withColumn("l_orderkey", F.split_part("order_id", F.lit("-"), F.lit(1)).cast("long"))
    return minutes.select("order_id", fx.hours_between(shipped, "_loaded_at").alias("hours"))


@query
def date_dims(spark, sf_dir):
    dims = fx.date_dims()
    return orders(spark, sf_dir, "order_id", "order_date").select(
        "order_id", *[expression.alias(name) for name, expression in dims.items()]
    )


@query
def churn_risk(spark, sf_dir):
    last = fx.days_between(F.max("order_date"), fx.as_date(AS_OF))
    recency = orders(spark, sf_dir, "customer_id", "order_date").groupBy("customer_id").agg(last.alias("days"))
    return recency.select("customer_id", fx.churn_risk("days").alias("churn_risk"))


@query
def customer_tier(spark, sf_dir):
    revenue = clean(spark, sf_dir).groupBy("customer_id").agg(F.sum("net_revenue").alias("revenue"))
    return revenue.select("customer_id", fx.customer_tier("revenue").alias("customer_tier"))


@query
def rfm_total(spark, sf_dir):
    ranked = scores(spark, sf_dir, *gold.RFM_SCORES)
    return ranked.select("customer_id", gold.rfm_total().alias("rfm_total"))


@query
def revenue_bands(spark, sf_dir):
    stg = orders(spark, sf_dir, "order_id", "quantity", "unit_price")
    return stg.select("order_id", fx.revenue_bands(fx.gross_revenue()).alias("revenue_band"))


@query
def safe_divide(spark, sf_dir):
    stg = orders(spark, sf_dir, "order_id", "quantity", "unit_price")
    return stg.select("order_id", fx.safe_divide("unit_price", "quantity").alias("price_per_unit"))


@query
def surrogate_key(spark, sf_dir):
    stg = orders(spark, sf_dir, "order_id", "customer_id", "order_date")
    return stg.select("order_id", fx.surrogate_key("order_id", "customer_id", "order_date").alias("order_sk"))


def _spine_counts(spark, sf_dir, datepart: str) -> DataFrame:
    """Orders per step of a spine that runs from the first to the last order date, empty steps included."""
    dates = tpch.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    steps = dates if datepart == "day" else dates.select(F.trunc("order_date", datepart).alias("order_date"))
    bounds = steps.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    spine = bounds.select(F.explode(fx.spine_dates(F.col("first"), F.col("last"), datepart)).alias("date_day"))
    counts = steps.groupBy(F.col("order_date").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query
def date_spine_day(spark, sf_dir):
    return _spine_counts(spark, sf_dir, "day")


@query
def date_spine_month(spark, sf_dir):
    return _spine_counts(spark, sf_dir, "month")


# --- models -------------------------------------------------------------------------------


@query
def stg_orders(spark, sf_dir):
    return orders(spark, sf_dir)


@query
def stg_customers(spark, sf_dir):
    return customers(spark, sf_dir)


@query
def int_orders_enriched(spark, sf_dir):
    return enriched(spark, sf_dir).drop("_transformed_at")


@query
def int_orders_incremental(spark, sf_dir):
    """The batch an incremental run merges when silver holds everything loaded up to the cut."""
    mark = dt.datetime.fromisoformat(CUT_TIME)
    new_orders = upsert.newer_than(orders(spark, sf_dir), mark)
    return silver.int_orders_enriched(new_orders, customers(spark, sf_dir), NOW).drop("_transformed_at")


@query
def mart_revenue_by_segment(spark, sf_dir):
    return gold.mart_revenue_by_segment(enriched(spark, sf_dir), START_DATE)


@query
def mart_customer_360(spark, sf_dir):
    # The metrics read no customer attribute, so the orders need not be joined to the customers first.
    return gold.mart_customer_360(
        clean(spark, sf_dir), customers(spark, sf_dir), AS_OF, refreshed_at=NOW
    ).drop("_refreshed_at")


# The given tables break these checks by their nature (see the mapping in sources/tpch.py).
EXPECTED_FAILURES = (
    ("raw_orders", "not_null_customer_id"),
    ("stg_orders", "not_null_customer_id"),
    ("stg_orders", "accepted_range_quantity"),
    ("int_orders_enriched", "accepted_range_days_to_ship"),
    ("int_orders_enriched", "relationships_customer_id"),
    ("mart_revenue_by_segment", "not_null_customer_segment"),
    ("mart_customer_360", "not_null_lifetime_order_count"),
    ("mart_customer_360", "not_null_rfm_total"),
)


def _run_summary(spark, sf_dir, label: str, runs_of_layers) -> DataFrame:
    """Rows per built table and failures per check that fails, of one run for each of the groups of layers."""
    store = LayerStore(spark, new_folder(spark, label))
    config = PipelineConfig(start_date=START_DATE, as_of=AS_OF, now=NOW, warn_only=EXPECTED_FAILURES)
    with dropped_after(spark):
        landed, people = landed_orders(spark, sf_dir), tpch.raw_customers(spark, sf_dir)
        runs = [run_pipeline(spark, landed, people, store, replace(config, layers=layers)) for layers in runs_of_layers]
    tables = {
        "silver.int_orders_enriched": store.read("silver", "int_orders_enriched", schemas.SILVER_TYPES),
        "gold.mart_revenue_by_segment": store.read("gold", "mart_revenue_by_segment"),
        "gold.mart_customer_360": store.read("gold", "mart_customer_360"),
    }
    rows = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("measure"), F.lit(name).alias("item"), "n")
        for name, df in tables.items()
    ]
    failing = [
        ("failures", f"{c['model']}.{c['check_type']}_{c['column_name']}", c["failures"])
        for run in runs
        for c in run.failed()
    ]
    failures = spark.createDataFrame(failing, "measure string, item string, n long")
    return reduce(DataFrame.unionByName, [*rows, failures])


@query
def layered_run_summary(spark, sf_dir):
    """The whole gated run; rows per built table and failures per check that fails."""
    return _run_summary(spark, sf_dir, "layered-run", [LAYERS])


@query
def layer_selection_summary(spark, sf_dir):
    """The same, each layer by a run of its own that selects only it."""
    return _run_summary(spark, sf_dir, "layer-selection", [[layer] for layer in LAYERS])


# --- checks -------------------------------------------------------------------------------


@query
def check_unique(spark, sf_dir):
    """Line numbers that the given orders repeat."""
    number = F.concat_ws("-", "l_orderkey", "l_linenumber")
    lines = tpch.table(spark, sf_dir, "lineitem").select(number.alias("order_id"))
    return checks.duplicate_keys(lines, "order_id")


@query
def check_not_null(spark, sf_dir):
    return checks.null_rows(orders(spark, sf_dir, "order_id", "customer_id"), "customer_id")


@query
def check_accepted_values(spark, sf_dir):
    rows = customers(spark, sf_dir, "customer_id", "customer_segment")
    return checks.unaccepted_rows(rows, "customer_segment", SEGMENTS[:2])


@query
def check_accepted_range(spark, sf_dir):
    rows = clean(spark, sf_dir).select("order_id", "days_to_ship")
    return checks.out_of_range_rows(rows, "days_to_ship", 0, 365)


@query
def check_relationships(spark, sf_dir):
    children = orders(spark, sf_dir, "customer_id")
    return checks.orphan_keys(children, customers(spark, sf_dir, "customer_id"), "customer_id")


@query
def check_not_null_pct(spark, sf_dir):
    return checks.null_share_above(orders(spark, sf_dir, "customer_id"), "customer_id")


@query
def check_freshness_hours(spark, sf_dir):
    return checks.stale(orders(spark, sf_dir, "_loaded_at"), "_loaded_at", now=AS_OF)


@query
def source_freshness(spark, sf_dir):
    return checks.source_freshness(tpch.raw_orders(spark, sf_dir, ["_loaded_at"]), "raw.orders", now=NOW)


@query
def check_row_count_growth(spark, sf_dir):
    """Rows of the gold tables of the orders loaded by the cut, against those of a year earlier.

    The revenue mart grows by a year of months; the other one has a row per customer, so it doesn't. An order's silver
    row is made from it alone, so the earlier silver is those rows of the later one.
    """
    people = materialize(customers(spark, sf_dir), "customers")

    def by(time: str) -> Column:
        return F.col("_loaded_at") <= F.lit(time).cast("timestamp_ntz")

    latest = max(CUT_TIME, EARLY_CUT_TIME)
    stored = silver.int_orders_enriched(orders(spark, sf_dir).filter(by(latest)), people, NOW)
    stored = materialize(stored.select(*gold.SILVER_COLUMNS, "_loaded_at"), "silver")
    unique = checks.proven_unique(stored, silver.KEY)

    def loaded_by(time: str) -> DataFrame:
        rows = stored.filter(by(time))
        marts = {
            "mart_revenue_by_segment": gold.mart_revenue_by_segment(rows, START_DATE, unique),
            "mart_customer_360": gold.mart_customer_360(
                rows, people, AS_OF, refreshed_at=NOW, order_ids_unique=unique
            ),
        }
        counts = [df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows")) for name, df in marts.items()]
        return reduce(DataFrame.unionByName, counts)

    return checks.row_counts_not_grown(loaded_by(CUT_TIME), loaded_by(EARLY_CUT_TIME))


@query
def dq_suite_shares_and_freshness(spark, sf_dir):
    """Declared checks of whole tables beside those of rows, in one scan."""
    declared = [
        checks.not_null("customer_id"),
        checks.not_null_share("customer_id"),
        checks.not_null_share("shipped_date", 0.75),
        checks.not_null_share("order_date", 1),
        checks.fresh("_loaded_at", 25),
        checks.fresh("_loaded_at", 5),
    ]
    columns = ("order_id", "customer_id", "order_date", "shipped_date", "_loaded_at")
    suite = checks.run_suite(orders(spark, sf_dir, *columns), "stg_orders", declared, now=NOW)
    return suite.drop("severity")


@query
def join_bucketed_left(spark, sf_dir):
    """Orders with their customer's attributes from tables in buckets of the customer: no side is shuffled."""
    rows = clean(spark, sf_dir).select("order_id", "customer_id", "net_revenue")
    people = customers(spark, sf_dir).select("customer_id", "customer_name", "customer_segment")
    left = write_bucketed(rows, new_folder(spark, "orders-bucketed"), "customer_id", BUCKETS)
    right = write_bucketed(people, new_folder(spark, "customers-bucketed"), "customer_id", BUCKETS)
    return left.join(right.hint("merge"), "customer_id", "left")


@query
def clustered_interleaved(spark, sf_dir):
    """Silver rows laid out by date and region at once."""
    path = new_folder(spark, "interleaved")
    with dropped_after(spark):  # the given columns move, the others are derived where they have come to lie
        laid = cluster_interleaved(silver.valid_orders(orders(spark, sf_dir)), silver.CLUSTER_BY, [silver.KEY])
        replace_table(silver.clean_orders(laid), path)
    return versions.read(spark, path)


@query
def filter_start_subquery(spark, sf_dir):
    """The revenue mart from a start that a query finds, the year of the newest order: months before it are not read."""
    path = new_folder(spark, "silver-by-month")
    with dropped_after(spark):
        _first_silver(bronze.stg_orders(landed_orders(spark, sf_dir)), customers(spark, sf_dir), path)
    stored = versions.read(spark, path, schemas.SILVER_TYPES)
    start = stored.agg(F.trunc(F.max("order_date"), "year")).scalar()
    return gold.mart_revenue_by_segment(stored, start)


def _suite(df: DataFrame, model: str, parents=None, counted=None) -> DataFrame:
    return checks.run_suite(df, model, CATALOG[model], parents, counted).drop("severity")


def _stored_suite(df: DataFrame, model: str, parents=None) -> DataFrame:
    """The suite of a table that is written here: its row checks are counted by the write itself."""
    spark = df.sparkSession
    path = new_folder(spark, model)
    snapshot = replace_table(df, path, layout=versions.Layout(row_checks=checks.row_checks(CATALOG[model])))
    return _suite(versions.read(spark, path, dict(df.dtypes), snapshot), model, parents, snapshot.failures)


@query
def dq_suite_source(spark, sf_dir):
    return _suite(tpch.raw_orders(spark, sf_dir, ["order_id", "customer_id", "order_date"]), "raw_orders").unionByName(
        _suite(tpch.raw_customers(spark, sf_dir), "raw_customers")
    )


@query
def dq_suite_bronze(spark, sf_dir):
    return _suite(orders(spark, sf_dir), "stg_orders").unionByName(
        _suite(customers(spark, sf_dir), "stg_customers")
    )


@query
def dq_suite_silver(spark, sf_dir):
    parents = {"stg_customers": customers(spark, sf_dir)}
    return _stored_suite(enriched(spark, sf_dir), "int_orders_enriched", parents)


@query
def dq_suite_gold(spark, sf_dir):
    silver_table = materialize(enriched(spark, sf_dir).select(*gold.SILVER_COLUMNS), "silver")
    unique = checks.proven_unique(silver_table, silver.KEY)
    revenue = gold.mart_revenue_by_segment(silver_table, START_DATE, unique)
    customer_360 = gold.mart_customer_360(
        silver_table, customers(spark, sf_dir), AS_OF, refreshed_at=NOW, order_ids_unique=unique
    )
    return _stored_suite(revenue, "mart_revenue_by_segment").unionByName(
        _stored_suite(customer_360, "mart_customer_360")
    )
