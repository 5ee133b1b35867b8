"""Sources, sinks, incremental loads, the gated run and the stream."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum import schemas
from stratum.operators import checks, upsert
from stratum.plans import bronze, silver
from stratum.plans.check_catalog import CATALOG
from stratum.plans.pipeline import SILVER, GateFailure, PipelineConfig, build_silver, run_pipeline
from stratum.sources import files, readers, versions
from stratum.sources.layers import LayerStore, cluster, create_view, replace_table
from stratum.sources.scratch import new_folder
from stratum.streaming.landing import merge_landed_orders, read_landed_orders
from tests.data import customer, customers, day, order, orders, raw

NOW = "2024-01-12 07:00:00"


def _driver_lost(*_, **__):
    raise RuntimeError("driver lost")


CONFIG = PipelineConfig(now=NOW, as_of="2024-02-01")


def loaded(day_of_month, hour=6):
    return f"2024-01-{day_of_month:02d}T{hour:02d}:00:00"


def load(spark, store, *rows, people=None, **config):
    settings = PipelineConfig(**({"now": NOW, "as_of": "2024-02-01"} | config))
    return build_silver(spark, orders(spark, *rows), customers(spark, *(people or [customer()])), store, settings)


def table(store):
    rows = store.read("silver", SILVER, schemas.SILVER_TYPES).collect()
    assert len({r["order_id"] for r in rows}) == len(rows)
    return {r["order_id"]: r for r in rows}


@pytest.fixture
def store(spark, folder):
    return LayerStore(spark, folder)


# --- sources and sinks --------------------------------------------------------------------


def test_csv_seed_empty_field_is_null_and_header_is_checked(spark, folder):
    path = f"{folder}/orders.csv"
    names = list(schemas.ORDER_TYPES)
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + ",".join(order(shipped_date="").values()) + "\n")
    row = bronze.stg_orders(readers.read_csv_seed(spark, path, schemas.ORDER_TYPES)).first()
    assert row["shipped_date"] is None and row["order_date"] == day("2024-01-10")
    assert row["_loaded_at"] == dt.datetime(2024, 1, 12, 6)
    swapped = {n: schemas.ORDER_TYPES[n] for n in [names[1], names[0], *names[2:]]}
    with pytest.raises(Exception, match="header"):
        readers.read_csv_seed(spark, path, swapped).collect()


def test_json_landing_names_its_file(spark, folder):
    with open(f"{folder}/batch_7.json", "w") as f:
        f.write(json.dumps({k: v for k, v in order().items() if k != "_source_file"}) + "\n")
    row = readers.read_json_landing(spark, folder, schemas.ORDER_TYPES).first()
    assert row["_source_file"] == "batch_7.json" and row["order_id"] == "A"


def test_json_landing_keeps_bad_lines_apart(spark, folder):
    lines = [json.dumps(order("A")), '{"order_id": "B", "quantity": ', "no json", json.dumps(order("C")), '["list"]', ""]
    for number in (1, 2):
        with open(f"{folder}/{number}.json", "w") as f:
            f.write("\n".join(lines) + "\n")
    good, bad = readers.split_json_landing(spark, folder, schemas.ORDER_TYPES)
    assert good.columns == list(schemas.ORDER_TYPES)
    assert sorted((r.order_id, r["_source_file"]) for r in good.collect()) == [
        ("A", "1.json"), ("A", "2.json"), ("C", "1.json"), ("C", "2.json")
    ]
    assert sorted(map(tuple, bad.collect())) == sorted((f"{n}.json", lines[i]) for n in (1, 2) for i in (1, 2, 4))


def test_replace_leaves_the_old_table_when_the_job_fails(spark, store):
    store.replace(spark.range(3), "gold", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        store.replace(broken, "gold", "t")
    assert store.read("gold", "t").count() == 3
    assert store.replace(spark.range(5), "gold", "t").count() == 5


def test_replace_cut_off_before_its_pointer_changes_nothing(spark, store, monkeypatch):
    store.replace(spark.range(3), "gold", "t")
    held = store.read("gold", "t")
    with monkeypatch.context() as patch:
        patch.setattr(versions.Observation, "get", property(_driver_lost))
        with pytest.raises(RuntimeError):
            store.replace(spark.range(5), "gold", "t")
    assert store.read("gold", "t").count() == 3
    assert store.replace(spark.range(7), "gold", "t").count() == 7
    assert held.count() == 3  # a reader of the earlier version still has all its files
    assert versions.expire(spark, store.path("gold", "t")) == 2
    assert store.read("gold", "t").count() == 7


def test_the_second_of_two_writers_is_refused(spark, store):
    path = store.path("gold", "t")
    store.replace(spark.range(3), "gold", "t")
    base = versions.current(spark, path)
    versions.commit(spark, spark.range(5), path, versions.Layout(), base=base)
    time.sleep(0.01)
    with pytest.raises(versions.ConcurrentCommit):
        versions.commit(spark, spark.range(9), path, versions.Layout(), base=base)
    assert store.read("gold", "t").count() == 5
    assert store.replace(spark.range(2), "gold", "t").count() == 2


def test_an_empty_table_has_a_version_too(spark, store):
    empty = spark.range(3).filter("id > 5")
    assert store.replace(empty, "gold", "t").collect() == []
    assert store.exists("gold", "t") and store.snapshot("gold", "t").n_rows == 0
    assert store.read("gold", "t", {"id": "bigint"}).dtypes == empty.dtypes
    assert not store.exists("gold", "other") and store.snapshot("gold", "other") is None


def test_a_write_observes_its_rows_and_row_checks(spark, store):
    fails = {"high": F.col("id") > 6, "odd": F.col("id") % 2 == 1}
    store.replace(spark.range(10), "gold", "t", row_checks=fails)
    snapshot = store.snapshot("gold", "t")
    assert (snapshot.n_rows, snapshot.failures("high"), snapshot.failures("odd")) == (10, 3, 5)
    assert snapshot.failures("other") is None


def test_a_model_can_be_rebuilt_from_itself(spark, store):
    store.replace(spark.range(3), "gold", "t")
    store.replace(store.read("gold", "t").filter("id > 0"), "gold", "t")
    assert store.read("gold", "t").count() == 2


def test_layers_as_databases(spark, store):
    load(spark, store, order("A"))
    name = store.publish("silver", SILVER, "try_")
    assert spark.table(name).select("order_id", "net_revenue").count() == 1
    raw(spark, [order("A", shipped_date=None)], schemas.ORDER_TYPES).createOrReplaceGlobalTempView("o")
    raw(spark, [customer()], schemas.CUSTOMER_TYPES).createOrReplaceGlobalTempView("c")
    with pytest.raises(PySparkException):  # a lasting view cannot stand on a temporary one
        bronze.publish_views(spark, "global_temp.o", "global_temp.c", "try_")
    for layer in ("bronze", "silver"):
        spark.sql(f"DROP DATABASE try_{layer} CASCADE")


def test_bronze_views_over_files(spark, folder):
    raw(spark, [order("A", shipped_date=None)], schemas.ORDER_TYPES).write.parquet(f"{folder}/o")
    raw(spark, [customer()], schemas.CUSTOMER_TYPES).write.parquet(f"{folder}/c")
    names = bronze.publish_views(spark, f"parquet.`{folder}/o`", f"parquet.`{folder}/c`", "files_")
    stg_orders, stg_customers = (spark.table(n) for n in names)
    assert stg_orders.schema == schemas.struct(schemas.ORDER_TYPES)
    assert stg_orders.first()["shipped_date"] is None and stg_customers.first()["is_active"] is True
    spark.sql("DROP DATABASE files_bronze CASCADE")


def test_view_is_not_stored(spark):
    view = create_view(spark.range(3).withColumn("x", F.col("id") * 2), "some_view")
    assert spark.table("some_view").count() == 3
    assert "Range" in view._jdf.queryExecution().executedPlan().toString()


def test_clustering_splits_one_frequent_value(spark):
    df = spark.range(4000).select(F.lit("same").alias("region"), F.col("id").cast("string").alias("order_id"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # would join these few rows again
    spark.conf.set(setting, "false")
    try:
        parts = cluster(df, ["region"], ["order_id"]).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    finally:
        spark.conf.unset(setting)
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) < 1000


def test_clustered_files_have_disjoint_ranges(spark, folder):
    df = spark.range(4000).select((F.col("id") % 100).cast("int").alias("k"), "id")
    replace_table(df, f"{folder}/t", ["k"])
    bounds = (
        versions.read(spark, f"{folder}/t").groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()
    )
    ranges = sorted((r[1], r[2]) for r in bounds)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


# --- incremental silver -------------------------------------------------------------------


def test_first_run_builds_everything_then_only_newer_rows_are_read(spark, store):
    assert load(spark, store, order("A", _loaded_at=loaded(12)), order("B", _loaded_at=None)) is None
    merged = load(
        spark,
        store,
        order("A", quantity="9", _loaded_at=loaded(13)),  # update
        order("C", _loaded_at=loaded(13)),  # insert
        order("D", _loaded_at=loaded(12)),  # same load time as the mark: not seen
        order("E", _loaded_at=loaded(11)),  # older: not seen
        order("F", _loaded_at=None),  # no load time: not seen
    )
    rows = table(store)
    assert merged == 2 and set(rows) == {"A", "B", "C"} and rows["A"]["quantity"] == 9


def test_lookback_reads_late_rows(spark, store):
    load(spark, store, order("A", _loaded_at=loaded(12)))
    load(spark, store, order("D", _loaded_at=loaded(12)), order("E", _loaded_at=loaded(10)), lookback_days=1)
    assert set(table(store)) == {"A", "D"}


def test_order_that_turns_bad_keeps_its_good_version(spark, store):
    load(spark, store, order("A"))
    load(spark, store, order("A", quantity="0", _loaded_at=loaded(13)), order("B", _loaded_at=loaded(13)))
    assert table(store)["A"]["quantity"] == 2


def test_customer_changes_do_not_reach_merged_orders_until_a_full_refresh(spark, store):
    load(spark, store, order("A"))
    moved = [customer(customer_segment="Enterprise")]
    load(spark, store, order("B", _loaded_at=loaded(13)), people=moved)
    assert {k: r["customer_segment"] for k, r in table(store).items()} == {"A": "SMB", "B": "Enterprise"}
    load(spark, store, order("A"), people=moved, full_refresh=True)
    assert {k: r["customer_segment"] for k, r in table(store).items()} == {"A": "Enterprise"}


def test_repeated_key_in_one_batch(spark, store):
    load(spark, store, order("A"))
    batch = [
        order("A", quantity="3", _loaded_at=loaded(13)),
        order("A", quantity="4", _loaded_at=loaded(14)),
        order("A", quantity="5", _loaded_at=loaded(13, 7)),
    ]
    with pytest.raises(upsert.DuplicateKeys):
        load(spark, store, *batch)
    assert table(store)["A"]["quantity"] == 2
    assert load(spark, store, *batch, on_duplicate="latest") == 1
    assert table(store)["A"]["quantity"] == 4


def test_row_moves_out_of_a_partition_of_one(spark, store):
    load(spark, store, order("A", order_date="2023-05-05"), order("B"))
    load(spark, store, order("A", order_date="2023-07-07", _loaded_at=loaded(13)))
    assert {k: r["order_month"] for k, r in table(store).items()} == {"A": day("2023-07-01"), "B": day("2024-01-01")}
    assert {p.part for p in store.snapshot("silver", SILVER).parts} == {"2023-07-01", "2024-01-01"}


def test_row_moves_between_partitions_that_keep_others(spark, store):
    load(spark, store, order("A"), order("B"), order("C", order_date="2024-02-02"))
    load(spark, store, order("A", order_date="2024-02-03", _loaded_at=loaded(13)))
    assert {k: r["order_month"].month for k, r in table(store).items()} == {"A": 2, "B": 1, "C": 2}


def test_row_leaves_a_partition_whose_folder_name_is_escaped(spark, folder):
    types = {"k": "string", "g": "string", "_loaded_at": "int"}
    path, rest = f"{folder}/t", (types, "k", "g", ["g"])
    struct = schemas.struct(types)
    upsert.full_load(spark.createDataFrame([("A", "a:b c%", 1), ("B", "x", 1)], struct), path, *rest)
    upsert.upsert(spark, spark.createDataFrame([("A", "x", 2)], struct), path, *rest)
    assert sorted((r.k, r.g) for r in versions.read(spark, path, types).collect()) == [("A", "x"), ("B", "x")]
    upsert.upsert(spark, spark.createDataFrame([("B", "a:b c%", 3)], struct), path, *rest)
    assert sorted((r.k, r.g) for r in versions.read(spark, path, types).collect()) == [("A", "x"), ("B", "a:b c%")]


@pytest.mark.parametrize("most", [10, 0])
def test_older_rows_do_not_replace_newer_ones(spark, store, monkeypatch, most):
    monkeypatch.setattr(upsert, "MOST_BROADCAST_KEYS", most)
    load(spark, store, order("A", quantity="8", _loaded_at=loaded(12)), order("B", _loaded_at=loaded(12)))
    late = [
        order("A", quantity="3", order_date="2023-03-03", _loaded_at=loaded(11)),
        order("B", quantity="4", _loaded_at=loaded(12)),
        order("C", _loaded_at=loaded(11)),
    ]
    assert load(spark, store, *late, lookback_days=3) == 3
    assert {k: r["quantity"] for k, r in table(store).items()} == {"A": 8, "B": 4, "C": 2}


def test_scratch_tables_go_with_the_run(spark, store):
    def scratch_tables():
        return files.children(spark, os.path.dirname(new_folder(spark, "x")))

    before = scratch_tables()
    run(spark, store, [order("A"), order("B")])
    run(spark, store, [order("A", _loaded_at=loaded(13))])
    assert scratch_tables() == before


def test_orders_without_a_date(spark, store):
    load(spark, store, order("A", order_date=None, shipped_date=None), order("B"))
    load(spark, store, order("A", quantity="7", _loaded_at=loaded(13)))
    load(spark, store, order("B", order_date=None, shipped_date=None, _loaded_at=loaded(14)))
    assert {k: r["order_date"] for k, r in table(store).items()} == {"A": day("2024-01-10"), "B": None}


def test_merge_rewrites_only_the_partitions_concerned(spark, store):
    load(spark, store, order("A", order_date="2023-05-05"), order("B", order_date="2023-06-06"))
    before = {p.part: p.version for p in store.snapshot("silver", SILVER).parts}
    load(spark, store, order("B", order_date="2023-06-07", _loaded_at=loaded(13)))
    after = {p.part: p.version for p in store.snapshot("silver", SILVER).parts}
    assert after["2023-05-01"] == before["2023-05-01"] and after["2023-06-01"] != before["2023-06-01"]


def test_merge_opens_only_files_that_can_hold_its_keys(spark, store, monkeypatch):
    old = [order(f"A{i}", order_date="2023-05-05") for i in range(3)]
    load(spark, store, *old, *[order(f"B{i}", order_date="2023-06-06") for i in range(3)])
    opened, read = [], versions.read

    def watched(spark, path, types=None, snapshot=None, parts=None):
        opened.append({p.part for p in parts or ()})
        return read(spark, path, types, snapshot, parts)

    monkeypatch.setattr(upsert.versions, "read", watched)
    load(spark, store, order("B1", order_date="2023-07-07", _loaded_at=loaded(13)))
    assert opened == [{"2023-06-01"}, {"2023-06-01"}]  # for its keys, then to write it anew
    opened.clear()
    load(spark, store, order("C1", order_date="2023-07-08", _loaded_at=loaded(14)))
    assert opened == [set(), {"2023-07-01"}]  # a key beyond all others: nothing is opened to look for it
    assert set(table(store)) == {"A0", "A1", "A2", "B0", "B1", "B2", "C1"}


def test_few_keys_are_tried_on_the_bloom_filters_of_the_files(spark, folder):
    types = {"k": "string", "v": "int"}
    rows = spark.range(20_000).select(F.concat(F.lit("key-"), F.col("id") * 2).alias("k"), F.col("id").cast("int").alias("v"))
    snapshot = replace_table(rows.coalesce(1), f"{folder}/t", layout=versions.Layout(key="k", bloom_rows=20_000), types=types)
    stored = versions.read(spark, f"{folder}/t", types, snapshot)

    def rows_out_of_scan(keys):
        found = stored.filter(upsert._any_of("k", keys))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    assert rows_out_of_scan([f"key-{2 * i + 1}" for i in range(25)]) == 0  # all lie between keys of the file
    assert rows_out_of_scan(["key-400"]) > 0


def test_the_first_batch_makes_the_table(spark, folder):
    types = {"k": "string", "g": "string", "_loaded_at": "timestamp_ntz"}
    path, rest = f"{folder}/t", (types, "k", "g", ["g"])
    batch = spark.createDataFrame([("A", "x", dt.datetime(2024, 1, 1))], schemas.struct(types))
    assert upsert.upsert(spark, batch.limit(0), path, *rest) == 0
    assert versions.current(spark, path).n_rows == 0
    for _ in range(2):
        assert upsert.upsert(spark, batch, path, *rest) == 1
        assert [(r.k, r.g) for r in versions.read(spark, path, types).collect()] == [("A", "x")]


def test_the_mark_is_read_from_the_log(spark, store):
    load(spark, store, order("A", _loaded_at=loaded(11)), order("B", order_date="2023-05-05", _loaded_at=loaded(12)))
    assert store.snapshot("silver", SILVER).newest == dt.datetime(2024, 1, 12, 6)


def test_empty_batch_changes_nothing(spark, store):
    load(spark, store, order("A"))
    assert load(spark, store, order("B", _loaded_at=loaded(1))) == 0
    assert set(table(store)) == {"A"}


@pytest.mark.parametrize("lost_in", ["cluster", "commit", "log"])
def test_merge_that_was_cut_off_is_run_again(spark, store, monkeypatch, lost_in):
    load(spark, store, order("A", order_date="2023-05-05"), order("B"), order("K"))
    batch = [order("A", order_date="2023-07-07", _loaded_at=loaded(13)), order("C", _loaded_at=loaded(14))]
    with monkeypatch.context() as patch:
        if lost_in == "log":  # the new files are complete, nothing points to them
            patch.setattr(versions, "_log_entry", _driver_lost)
        else:
            patch.setattr(upsert if lost_in == "cluster" else versions, lost_in, _driver_lost)
        with pytest.raises(RuntimeError):
            load(spark, store, *batch)
    assert set(table(store)) == {"A", "B", "K"}
    load(spark, store, *batch)
    rows = table(store)
    assert set(rows) == {"A", "B", "C", "K"} and rows["A"]["order_date"] == day("2023-07-07")
    assert files.children(spark, f"{store.root}/silver") == [SILVER]


def test_row_checks_of_silver_are_summed_over_versions(spark, store):
    late = {"shipped_date": "2026-01-01"}  # 700 days: beyond the accepted range
    load(spark, store, order("A", **late), order("B", order_date="2023-05-05", shipped_date=None))
    name = "accepted_range_days_to_ship"
    assert store.snapshot("silver", SILVER).failures(name) == 1
    load(spark, store, order("C", order_date="2023-05-06", _loaded_at=loaded(13), **late))
    assert store.snapshot("silver", SILVER).failures(name) == 2
    load(spark, store, order("A", _loaded_at=loaded(14)))
    assert store.snapshot("silver", SILVER).failures(name) == 1


def test_suite_takes_counted_row_checks_without_a_scan(spark, store):
    load(spark, store, order("A", shipped_date="2026-01-01"))
    rows, people = store.read("silver", SILVER, schemas.SILVER_TYPES), {"stg_customers": customers(spark, customer())}
    scanned = checks.run_suite(rows, SILVER, CATALOG[SILVER], people)
    counted = checks.run_suite(rows, SILVER, CATALOG[SILVER], people, store.snapshot("silver", SILVER).failures)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # uniqueness and relationships
    assert sorted(scanned.collect()) == sorted(counted.collect())


def test_upsert_is_idempotent(spark, store):
    load(spark, store, order("A"))
    batch = silver.int_orders_enriched(
        orders(spark, order("A", quantity="5"), order("B")), customers(spark, customer()), NOW
    )
    layout = (schemas.SILVER_TYPES, silver.KEY, "order_month", silver.CLUSTER_BY)
    for _ in range(2):
        upsert.upsert(spark, batch, store.path("silver", SILVER), *layout)
        assert {k: r["quantity"] for k, r in table(store).items()} == {"A": 5, "B": 2}


def test_watermark_filter_reaches_the_scan(spark, folder):
    orders(spark, order()).write.parquet(f"{folder}/o")
    stored = readers.read_parquet(spark, f"{folder}/o", schemas.ORDER_TYPES)
    plan = upsert.newer_than(stored, dt.datetime(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_loaded_at" in plan


# --- the gated run ------------------------------------------------------------------------


def run(spark, store, order_rows, people=None, config=CONFIG):
    return run_pipeline(
        spark,
        raw(spark, order_rows, schemas.ORDER_TYPES),
        raw(spark, people or [customer()], schemas.CUSTOMER_TYPES),
        store,
        config,
    )


def test_clean_run(spark, store):
    result = run(spark, store, [order("A"), order("B")])
    assert len(result.checks) == 85 and result.failed() == []
    assert result.freshness[0]["status"] == "pass"
    assert result.row_counts == {"mart_revenue_by_segment": 1, "mart_customer_360": 1}


def test_stale_source_stops_the_run(spark, store):
    with pytest.raises(GateFailure, match="stale"):
        run(spark, store, [order("A", _loaded_at=loaded(11))])
    assert not store.exists("silver", SILVER)


def test_bronze_failure_stops_silver(spark, store):
    with pytest.raises(GateFailure, match="accepted_range"):
        run(spark, store, [order("A"), order("B", quantity="0")])
    assert not store.exists("silver", SILVER)


def test_silver_failure_stops_gold(spark, store):
    with pytest.raises(GateFailure, match="relationships"):
        run(spark, store, [order("A", customer_id="C9")])
    assert store.exists("silver", SILVER) and not store.exists("gold", "mart_customer_360")


def test_customer_without_orders_fails_gold_unless_only_warned(spark, store):
    people = [customer("C1"), customer("C2")]
    with pytest.raises(GateFailure, match="rfm_total"):
        run(spark, store, [order("A")], people)
    warned = [("mart_customer_360", "not_null_lifetime_order_count"), ("mart_customer_360", "not_null_rfm_total")]
    result = run(
        spark, store, [order("A")], people, PipelineConfig(now=NOW, as_of="2024-02-01", warn_only=warned)
    )
    assert [(c["column_name"], c["failures"]) for c in result.failed()] == [
        ("lifetime_order_count", 1),
        ("rfm_total", 1),
    ]


def test_row_counts_are_compared_with_the_day_before(spark, store):
    assert run(spark, store, [order("A")]).not_grown == []
    assert run(spark, store, [order("A")]).not_grown == []  # again on the same day
    later = [order("B", order_date="2024-02-02", shipped_date=None, _loaded_at=loaded(13))]
    now = PipelineConfig(now="2024-01-13 07:00:00", as_of="2024-03-01")
    assert run(spark, store, later, config=now).not_grown == ["mart_customer_360"]
    strict = PipelineConfig(now="2024-01-13 07:00:00", as_of="2024-03-01", row_count_severity="error")
    with pytest.raises(GateFailure, match="grow"):
        run(spark, store, later, config=strict)
    grown = [customer(), customer("C9", email="c9@x.org")]
    again = [*later, order("D", customer_id="C9", order_date="2024-02-02", shipped_date=None, _loaded_at=loaded(14))]
    assert run(spark, store, again, people=grown, config=strict).not_grown == []  # a retry can pass


def test_layers_can_be_run_one_by_one(spark, store):
    def only(layer):
        return PipelineConfig(now=NOW, as_of="2024-02-01", layers=[layer])

    assert {c["model"] for c in run(spark, store, [order()], config=only("bronze")).checks} == {
        "raw_orders",
        "raw_customers",
        "stg_orders",
        "stg_customers",
    }
    assert not store.exists("silver", SILVER)
    run(spark, store, [order()], config=only("silver"))
    assert store.exists("silver", SILVER) and not store.exists("gold", "mart_customer_360")
    run(spark, store, [order()], config=only("gold"))
    assert store.exists("gold", "mart_customer_360")
    with pytest.raises(ValueError):
        run(spark, store, [order()], config=only("platinum"))


def test_silver_partitioned_by_day(spark, store):
    load(spark, store, order("A"), order("B", order_date="2024-01-11"), partition_by="order_date")
    load(spark, store, order("A", order_date="2024-01-12", _loaded_at=loaded(13)), partition_by="order_date")
    assert {k: r["order_date"] for k, r in table(store).items()} == {"A": day("2024-01-12"), "B": day("2024-01-11")}


# --- the stream ---------------------------------------------------------------------------


def test_landed_files_are_merged_once(spark, store, folder):
    landing = f"{folder}/landing"
    os.mkdir(landing)

    def land(name, *rows):
        with open(f"{landing}/{name}", "w") as f:
            for r in rows:
                f.write(json.dumps({k: v for k, v in r.items() if k != "_source_file"}) + "\n")

    def merge():
        stream = read_landed_orders(spark, landing)
        people = customers(spark, customer())
        merge_landed_orders(stream, people, store, f"{folder}/checkpoint", CONFIG).awaitTermination()

    land("a.json", order("A"), order("B", quantity="0"))
    merge()
    assert set(table(store)) == {"A"}
    land("b.json", order("A", quantity="7"), order("C", _loaded_at=loaded(1)))  # C is late, yet seen
    merge()
    merge()
    assert {k: r["quantity"] for k, r in table(store).items()} == {"A": 7, "C": 2}
