"""The daily run: freshness, then each layer followed by its checks, then row counts.

A failed check of severity ``error`` raises and the layers after it are not built.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import functions as fx
from stratum.operators import checks, upsert
from stratum.plans import bronze, gold, partials, silver
from stratum.plans.check_catalog import checks_for
from stratum.schemas import SILVER_TYPES
from stratum.sources.layers import LAYERS, LayerStore, create_view
from stratum.sources.readers import read_appended
from stratum.sources.scratch import dropped_after, shuffles_dropped

SILVER = "int_orders_enriched"
GOLD = ("mart_revenue_by_segment", "mart_customer_360")


class GateFailure(RuntimeError):
    """A check failed, so the layers behind it were not built."""


@dataclass
class PipelineConfig:
    start_date: dt.date | str = gold.START_DATE
    as_of: dt.date | str | None = None
    now: dt.datetime | str | None = None
    layers: Sequence[str] = LAYERS
    full_refresh: bool = False
    lookback_days: int = 0
    on_duplicate: str = "raise"
    partition_by: str = "order_month"
    recency_direction: str = "as_written"
    check_freshness: bool = True
    # (model, check name) pairs that report without blocking, such as ("stg_orders", "not_null_customer_id").
    warn_only: Iterable[tuple[str, str]] = ()
    row_count_severity: str = "warn"
    # Marts from stored sums of each month, of which only those of changed months are made anew.
    incremental_gold: bool = False


@dataclass
class PipelineRun:
    freshness: list[dict] = field(default_factory=list)
    checks: list[dict] = field(default_factory=list)
    row_counts: dict[str, int] = field(default_factory=dict)
    merged_rows: int | None = None
    not_grown: list[str] = field(default_factory=list)

    def failed(self, severity: str | None = None) -> list[dict]:
        return [
            c for c in self.checks if c["failures"] and (severity is None or c["severity"] == severity)
        ]


def run_pipeline(
    spark: SparkSession,
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    store: LayerStore,
    config: PipelineConfig | None = None,
) -> PipelineRun:
    config = config or PipelineConfig()
    unknown = set(config.layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    run = PipelineRun()
    orders = create_view(bronze.stg_orders(raw_orders), "stg_orders")
    customers = create_view(bronze.stg_customers(raw_customers), "stg_customers")

    if config.check_freshness:
        _check_freshness(raw_orders, config, run)
    if "bronze" in config.layers:
        # Bronze is only views, so its checks and those of the sources are one job and share its shuffles.
        sources = {"raw_orders": raw_orders, "raw_customers": raw_customers}
        _gate(run, config, sources | {"stg_orders": orders, "stg_customers": customers})
    if "silver" in config.layers:
        run.merged_rows = build_silver(spark, orders, customers, store, config, _proven(run, *_KEYS_OF_SILVER))
        _gate(run, config, {SILVER: _silver(store)}, parents={"stg_customers": customers}, store=store, layer="silver")
    if "gold" in config.layers:
        tables = build_gold(_silver(store), customers, store, config, order_ids_unique=_proven(run, _UNIQUE_IDS))
        _gate(run, config, tables, store=store, layer="gold")
        _check_row_counts(spark, tables, store, config, run)
    return run


def build_silver(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    store: LayerStore,
    config: PipelineConfig | None = None,
    keys_proven: bool = False,
) -> int | None:
    """Merge the new orders into silver; returns their number, or None after a full build.

    A full build of orders whose keys are known to stand once needs no check of its own for repeated ones.
    """
    config = config or PipelineConfig()
    path = store.path("silver", SILVER)
    layout = (SILVER_TYPES, silver.KEY, config.partition_by, silver.CLUSTER_BY)
    held = None if config.full_refresh else store.snapshot("silver", SILVER)
    present = held is not None and held.n_rows > 0
    if present:
        # A table without any load time has no mark that an order could be newer than.
        mark = held.newest
        new_orders = upsert.newer_than(orders, mark, lookback_days=config.lookback_days) if mark else orders.limit(0)
    written = {"on_duplicate": config.on_duplicate, "row_checks": checks.row_checks(checks_for(SILVER))}
    with dropped_after(spark):
        enriched = partial(silver.int_orders_enriched, customers=customers, processed_at=config.now)
        if present:
            return upsert.upsert(spark, enriched(new_orders), path, *layout, **written)
        if config.on_duplicate != "raise":
            upsert.full_load(enriched(orders), path, *layout, **written)
            return None
        if not keys_proven:
            upsert.refuse_duplicates(enriched(orders), silver.KEY)
        ranges = upsert.leading(config.partition_by, silver.CLUSTER_BY)
        written |= {"on_duplicate": None, "ranged": True}
        upsert.full_load(enriched(orders, ranged_by=ranges), path, *layout, **written)
        return None


def build_gold(
    orders: DataFrame,
    customers: DataFrame,
    store: LayerStore,
    config: PipelineConfig | None = None,
    order_ids_unique: bool = False,
) -> dict[str, DataFrame]:
    """Rebuild both marts. Order ids that are known, or shown here, to be unique need no distinct count.

    With ``incremental_gold`` the orders are not read but for the months of silver that have changed since.
    """
    config = config or PipelineConfig()
    with dropped_after(store.spark):
        if config.incremental_gold:
            partials.refresh(store, SILVER)
            revenue = partials.mart_revenue_by_segment(store, config.start_date)
            metrics = partials.customer_metrics(store, config.as_of)
        else:
            unique = order_ids_unique or checks.proven_unique(orders, "order_id")
            revenue = gold.mart_revenue_by_segment(orders, config.start_date, unique)
            metrics = gold.customer_metrics(orders, config.as_of, unique)
        customer_360 = gold.customer_360_of(metrics, customers, config.recency_direction, refreshed_at=config.now)
        return {
            GOLD[0]: store.replace(revenue, "gold", GOLD[0], row_checks=checks.row_checks(checks_for(GOLD[0]))),
            GOLD[1]: store.replace(
                customer_360,
                "gold",
                GOLD[1],
                cluster_by=gold.CUSTOMER_360_CLUSTER_BY,
                spread_by=["customer_id"],
                row_checks=checks.row_checks(checks_for(GOLD[1])),
            ),
        }


#: What shows that silver's order ids are unique, by model, column and check.
_UNIQUE_IDS = (SILVER, "order_id", "unique")
#: What shows that no order id, nor NULL, will stand twice in a silver made from bronze: each order meets one customer.
_KEYS_OF_SILVER = (
    ("stg_orders", "order_id", "unique"), ("stg_orders", "order_id", "not_null"), ("stg_customers", "customer_id", "unique"),
)


def _proven(run: PipelineRun, *wanted: tuple[str, str, str]) -> bool:
    """Whether this run has made all those checks and none of them found a failure."""
    failures = {(c["model"], c["column_name"], c["check_type"]): c["failures"] for c in run.checks}
    return all(failures.get(check) == 0 for check in wanted)


def _silver(store: LayerStore) -> DataFrame:
    return store.read("silver", SILVER, SILVER_TYPES)


def _check_freshness(raw_orders: DataFrame, config: PipelineConfig, run: PipelineRun) -> None:
    run.freshness = [
        r.asDict() for r in checks.source_freshness(raw_orders, "raw.orders", now=config.now).collect()
    ]
    late = [f for f in run.freshness if f["status"] == "error"]
    if late:
        raise GateFailure(f"stale sources: {late}")


def _gate(
    run: PipelineRun,
    config: PipelineConfig,
    tables: dict[str, DataFrame],
    parents: dict[str, DataFrame] | None = None,
    store: LayerStore | None = None,
    layer: str = "",
) -> None:
    """Run the declared checks of the tables and raise if a blocking one fails.

    The row checks of a stored table were counted when it was written.
    """
    counted = {model: store.snapshot(layer, model).failures if store else None for model in tables}
    suites = [
        checks.run_suite(df, model, checks_for(model, config.warn_only), parents, counted[model])
        for model, df in tables.items()
    ]
    suite = reduce(DataFrame.unionByName, suites)
    with shuffles_dropped(suite.sparkSession):
        results = [r.asDict() for r in suite.collect()]
    run.checks += results
    failed = [r for r in results if r["failures"] and r["severity"] == "error"]
    if failed:
        raise GateFailure(f"failed checks: {failed}")


def _check_row_counts(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    store: LayerStore,
    config: PipelineConfig,
    run: PipelineRun,
) -> None:
    """Compare the gold row counts with the last ones of an earlier day, and record them if this run passes."""
    run.row_counts = {model: store.snapshot("gold", model).n_rows for model in tables}
    counts = spark.createDataFrame(list(run.row_counts.items()), "model string, n_rows long")
    types = {"run_at": "timestamp_ntz", "model": "string", "n_rows": "bigint"}
    history = read_appended(spark, store.path("runs", "row_counts"), types)
    if history is not None:
        earlier = F.to_date("run_at") < F.to_date(fx.as_timestamp(config.now))
        previous = history.filter(earlier).groupBy("model").agg(F.max_by("n_rows", "run_at").alias("n_rows"))
        run.not_grown = sorted(
            r["model"] for r in checks.row_counts_not_grown(counts, previous).collect()
        )
    if run.not_grown and config.row_count_severity == "error":
        raise GateFailure(f"row counts did not grow: {run.not_grown}")
    counts.select(fx.as_timestamp(config.now).alias("run_at"), "model", "n_rows").write.mode("append").parquet(
        store.path("runs", "row_counts")
    )
