"""What moves between tasks and to disk: only what the step needs."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from stratum import schemas
from stratum.operators import checks, joins, upsert
from stratum.plans import gold, silver
from stratum.plans.pipeline import PipelineConfig, build_gold, build_silver, run_pipeline
from stratum.registry import spark_queries
from stratum.sources import files, layers, scratch, tpch, versions
from stratum.sources.scratch import materialize, new_folder
from tests.conftest import SF_DIR
from tests.data import customer, customers, order, orders


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_range_is_found_by_halving(spark):
    starts = [F.lit(10 * i) for i in range(1, 64)]
    number = layers._range_number(F.col("v"), starts)
    rows = spark.createDataFrame([(v,) for v in (None, -5, 0, 9, 10, 11, 315, 630, 999)], "v int")
    found = rows.select(number.alias("n")).collect()
    assert [r.n for r in found] == [0, 0, 0, 0, 1, 1, 31, 63, 63]


def test_rows_are_read_once_from_their_source_to_be_interleaved(spark):
    source = materialize(spark.range(100).select("id", (F.col("id") % 7).alias("b")), "source")
    laid = layers.cluster_interleaved(source, ["id", "b"])
    assert "source-" not in plan_of(laid) and laid.count() == 100


def test_the_join_with_customers_moves_given_columns_only(spark):
    rows = silver.int_orders_enriched(
        orders(spark, order("A"), order("B", customer_id=None)), customers(spark, customer()), broadcast_customers=False
    )
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "net_revenue" not in plan[plan.index("Join LeftOuter") :]
    assert [(r.order_id, r.customer_name, str(r.net_revenue)) for r in rows.collect()] == [("A", "Name C1", "20.000000")]


def test_a_dimension_of_a_hundred_megabytes_is_broadcast(spark):
    dimension = spark.range(1_200_000).select(F.col("id").cast("string").alias("k"), F.lit("x" * 50).alias("v"))
    assert joins.fits_broadcast(dimension)


def test_a_partition_of_which_every_row_is_replaced_is_not_read(spark, folder, monkeypatch):
    types = {"k": "string", "g": "string", "v": "int"}
    path, struct = f"{folder}/t", schemas.struct(types)
    rest = (types, "k", "g", ["g"])
    held = [("A", "x", 1), ("A", "x", 2), ("B", "x", 1), ("C", "y", 1), ("D", "y", 5), (None, "z", 1), ("E", "z", 1)]
    upsert.full_load(spark.createDataFrame(held, struct), path, *rest)
    opened, read = [], versions.read

    def watched(spark, path, types=None, snapshot=None, parts=None):
        opened.append({p.part for p in parts or ()})
        return read(spark, path, types, snapshot, parts)

    monkeypatch.setattr(upsert.versions, "read", watched)
    batch = [("A", "y", 7), ("B", "x", 7), ("C", "y", 7), ("D", "y", 4), ("E", "z", 7)]
    assert upsert.upsert(spark, spark.createDataFrame(batch, struct), path, *rest, order="v") == 5
    assert opened[1] == {"y", "z"}  # D's row is newer than the batch's, and a row without a key is never replaced
    found = [tuple(r) for r in read(spark, path, types).collect()]
    assert sorted(found, key=str) == sorted(
        [("A", "y", 7), ("B", "x", 7), ("C", "y", 7), ("D", "y", 5), ("E", "z", 7), (None, "z", 1)], key=str
    )


def test_tables_are_written_with_zstd(spark):
    path = new_folder(spark, "zstd")
    layers.replace_table(spark.range(10), path)
    stored = materialize(spark.range(10), "zstd-scratch").inputFiles()
    version = next(f for f in files.children(spark, path) if f.startswith("version="))
    names = [f for f in [*files.children(spark, f"{path}/{version}"), *stored] if f.endswith(".parquet")]
    assert names and all(f.endswith(".zstd.parquet") for f in names)


def test_a_digest_tells_rows_apart(spark):
    rows = [("a", "b"), ("a|b", ""), ("", "a|b"), ("a", None), (None, "a"), ("", None), (None, ""), (None, None), ("1:", "-")]
    df = spark.createDataFrame(rows, "x string, y string").select(spark_queries._digest(["x", "y"]).alias("d"))
    assert df.distinct().count() == len(rows)
    assert df.unionByName(df).distinct().count() == len(rows)


def test_orders_do_not_move_to_the_files_they_came_from(spark):
    plan = plan_of(spark_queries.json_roundtrip(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_ids_are_proven_unique_by_their_hashes(spark, monkeypatch):
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "k string")
    assert checks.proven_unique(ids("a", "b", None, None), "k") and checks.proven_unique(ids(), "k")
    assert not checks.proven_unique(ids("a", "b", "a"), "k")
    counted, plain = [], checks.duplicate_keys
    monkeypatch.setattr(checks, "duplicate_keys", lambda df, column: counted.append(column) or plain(df, column))
    assert checks.proven_unique(ids("a", "b"), "k") and counted == ["_hash"]
    monkeypatch.setattr(checks.F, "xxhash64", lambda column: F.length(column))  # values of one hash
    assert checks.proven_unique(ids("a", "b"), "k") and not checks.proven_unique(ids("a", "a"), "k")


@pytest.mark.parametrize("name,silvers", [("check_row_count_growth", 1), ("dq_suite_gold", 1)])
def test_marts_of_unique_orders_take_plain_counts_of_one_silver(spark, monkeypatch, name, silvers):
    built, counts = [], []
    enriched, measures = silver.int_orders_enriched, gold._order_measures
    monkeypatch.setattr(silver, "int_orders_enriched", lambda *a, **b: built.append(1) or enriched(*a, **b))
    monkeypatch.setattr(gold, "_order_measures", lambda unique: counts.append(unique) or measures(unique))
    spark_queries.queries()[name](spark, SF_DIR).collect()
    assert len(built) == silvers and counts and all(counts)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_dealt_out_by_ranges_move_given_columns_only(spark, broadcast):
    rows = [order(f"A{i}", order_date=dt.date(2023, 1 + i % 3, 5), customer_id=f"C{i % 2}") for i in range(12)]
    given, people = orders(spark, *rows), customers(spark, customer())
    plain = silver.int_orders_enriched(given, people, "2024-01-01 00:00:00")
    ranged = silver.int_orders_enriched(given, people, "2024-01-01 00:00:00", broadcast, ["order_month", "region"])
    assert ranged.columns == plain.columns and sorted(ranged.collect(), key=str) == sorted(plain.collect(), key=str)
    plan = ranged._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression") :]
    assert "net_revenue" not in moved and ("customer_name" in moved.split("LogicalRDD")[0]) != broadcast


def test_a_first_build_deals_out_narrow_rows_and_sorts_them(spark, folder):
    rows = [order(f"A{i:02}", order_date=dt.date(2023, 1 + i % 3, 28 - i), region=("East", "West")[i % 2]) for i in range(20)]
    store = layers.LayerStore(spark, folder)
    build_silver(spark, orders(spark, *rows), customers(spark, customer()), store, PipelineConfig(now="2024-01-01 00:00:00"))
    stored = store.read("silver", "int_orders_enriched", schemas.SILVER_TYPES)
    assert {r.order_id for r in stored.collect()} == {f"A{i:02}" for i in range(20)}
    named = stored.select(F.input_file_name().alias("file"), "order_date", "region").collect()
    for file in {r.file for r in named}:
        own = [(r.order_date, r.region) for r in named if r.file == file]
        assert own == sorted(own)


def test_a_first_build_counts_keys_unless_bronze_has_shown_them_unique(spark, folder, monkeypatch):
    refused, refuse = [], upsert.refuse_duplicates
    monkeypatch.setattr(upsert, "refuse_duplicates", lambda df, key: refused.append(key) or refuse(df, key))
    people = customers(spark, customer())
    config = PipelineConfig(now="2024-01-01 00:00:00", check_freshness=False, layers=("bronze", "silver"))
    for number, (rows, counted) in enumerate([([order("A"), order("B")], 0), ([order("A"), order("A")], 1)]):
        store = layers.LayerStore(spark, f"{folder}/{number}")
        warned = PipelineConfig(**config.__dict__ | {"warn_only": [(m, "unique_order_id") for m in ("raw_orders", "stg_orders")]})
        if counted:
            with pytest.raises(upsert.DuplicateKeys):
                run_pipeline(spark, orders(spark, *rows), people, store, warned)
        else:
            run_pipeline(spark, orders(spark, *rows), people, store, warned)
        assert len(refused) == counted
    with pytest.raises(upsert.DuplicateKeys):
        build_silver(spark, orders(spark, order("A"), order("A")), people, layers.LayerStore(spark, f"{folder}/x"), config)


def _shuffle_files(spark) -> int:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return blocks.getAllFiles().mkString("\n").count("shuffle_")


def test_what_a_write_has_shuffled_leaves_the_disk(spark, folder):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(5, "k")
    before = _shuffle_files(spark)
    for _ in range(20):
        stored = materialize(grouped, "grouped")
        layers.replace_table(grouped, f"{folder}/t")
    until = time.time() + 20  # files are removed in the background
    while _shuffle_files(spark) > before + 10 and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before + 10
    assert stored.count() == 7 and grouped.count() == 7 and len(grouped.collect()) == 7


def test_shuffles_are_dropped_within_the_block_only(spark):
    name = scratch._CLEANUP
    was = spark.conf.get(name, None)
    with pytest.raises(ValueError), scratch.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == was


def test_lines_meet_their_parts_before_the_columns_of_their_orders(spark):
    plan = tpch.raw_orders(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("= o_orderkey") < plan.index("= p_partkey")


def test_joined_rows_are_stored_between_the_two_shuffles(spark):
    given, people = orders(spark, order("A"), order("B", customer_id="none")), customers(spark, customer())
    ranged = silver.int_orders_enriched(given, people, "2024-01-01 00:00:00", False, ["order_month"])
    assert all("/joined-orders-" in f for f in ranged.inputFiles()) and "Join" not in plan_of(ranged)
    assert {(r.order_id, r.customer_name) for r in ranged.collect()} == {("A", "Name C1"), ("B", None)}


@pytest.mark.parametrize("ids,plain", [("AB", True), ("AA", False)])
def test_gold_that_is_built_alone_shows_order_ids_unique_itself(spark, folder, monkeypatch, ids, plain):
    counts, measures = [], gold._order_measures
    given, people = orders(spark, *[order(i) for i in ids]), customers(spark, customer())
    stored = materialize(silver.int_orders_enriched(given, people, "2024-01-01 00:00:00"), "silver")
    monkeypatch.setattr(gold, "_order_measures", lambda unique: counts.append(unique) or measures(unique))
    config = PipelineConfig(now="2024-01-01 00:00:00", as_of="2024-02-01")
    tables = build_gold(stored, people, layers.LayerStore(spark, folder), config)
    assert counts == [plain, plain]
    assert [r.order_count for r in tables["mart_revenue_by_segment"].collect()] == [len(set(ids))]
    assert [r.lifetime_order_count for r in tables["mart_customer_360"].collect()] == [len(set(ids))]


def test_interleaved_rows_move_with_their_given_columns_only(spark, monkeypatch):
    moved, interleave = [], spark_queries.cluster_interleaved
    monkeypatch.setattr(spark_queries, "cluster_interleaved", lambda df, *rest: moved.append(df.columns) or interleave(df, *rest))
    rows = spark_queries.clustered_interleaved(spark, SF_DIR)
    assert set(moved[0]) == {*silver._GIVEN, "_loaded_at"}
    assert rows.columns == silver.clean_orders(spark_queries.orders(spark, SF_DIR)).columns


@pytest.mark.parametrize("name", ["clustered_interleaved", "filter_start_subquery", "full_vs_incremental_equiv", "layered_run_summary"])
def test_tables_that_the_result_does_not_read_are_gone(spark, name):
    app = f"{scratch.scratch_root(spark)}/stratum/{spark.sparkContext.applicationId}"
    before = set(files.children(spark, app)) if files.exists(spark, app) else set()
    rows = spark_queries.queries()[name](spark, SF_DIR)
    left = set(files.children(spark, app)) - before
    assert not [f for f in left if f.startswith(("raw-orders-", "to-interleave-", "joined-orders-"))]
    assert rows.count()
