import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import checks, joins, ranking
from stratum.operators.dedup import first_per_key
from stratum.operators.ranking import Ranking, add_ntiles, tile_starts
from stratum.sources.scratch import materialize

# --- ntile --------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 5, 6, 7, 11, 23, 100])
@pytest.mark.parametrize("tiles", [1, 3, 5])
def test_tile_starts(rows, tiles):
    sizes = [rows // tiles + (1 if t < rows % tiles else 0) for t in range(tiles)]
    labels = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    starts = tile_starts(rows, tiles)
    assert [1 + sum(s <= i for s in starts) for i in range(rows)] == labels


def ranked(spark, rows):
    return materialize(spark.createDataFrame(rows, "id string, few int, money decimal(20,6)"), "ranked")


def assert_same_as_window(df, **sizes):
    rankings = [
        Ranking("few_asc", "few"),
        Ranking("few_desc", "few", True),
        Ranking("money_asc", "money"),
        Ranking("money_desc", "money", True),
    ]
    actual = add_ntiles(df, "id", rankings, 5, **sizes)
    window = {
        "few_asc": F.asc_nulls_last("few"),
        "few_desc": F.desc_nulls_first("few"),
        "money_asc": F.asc_nulls_last("money"),
        "money_desc": F.desc_nulls_first("money"),
    }
    expected = df.withColumns(
        {n: F.ntile(5).over(Window.orderBy(order, F.asc("id"))).cast("int") for n, order in window.items()}
    )
    assert sorted(map(tuple, actual.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def random_rows(n, seed):
    rng = random.Random(seed)

    def row(i):
        # A third of the rows share one key, and some have none.
        few = None if rng.random() < 0.05 else (1 if rng.random() < 0.35 else rng.randrange(20))
        money = None if rng.random() < 0.05 else Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-6)
        return (f"id{i:06d}", few, money)

    return [row(i) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 12])
def test_ntile_of_few_rows(spark, n):
    assert_same_as_window(ranked(spark, random_rows(n, n)))


def test_ntile_with_all_keys_tied(spark):
    assert_same_as_window(ranked(spark, [(f"id{i}", 1, None) for i in range(13)]))


def test_ntile_narrows_down_to_the_same_result(spark):
    df = ranked(spark, random_rows(5000, 1))
    assert_same_as_window(df, sample_rows=100, enclosed_rows=50)
    assert_same_as_window(df, sample_rows=1000, enclosed_rows=5000)


def test_ntile_recovers_from_a_misleading_sample(spark, monkeypatch):
    df = ranked(spark, random_rows(3000, 2))
    honest = ranking._suggest

    def lowest_only(df, tie, of, searches, rows, total):
        if total == 3000:
            return honest(df.filter("money < 0"), tie, of, searches, rows, total)
        return honest(df, tie, of, searches, rows, total)

    monkeypatch.setattr(ranking, "_suggest", lowest_only)
    assert_same_as_window(df, sample_rows=120, enclosed_rows=200)


@pytest.mark.parametrize("kind", ["double", "date", "string"])
@pytest.mark.parametrize("descending", [False, True])
def test_ntile_of_other_types(spark, kind, descending):
    number = "case when i % 9 = 0 then null when i % 4 = 0 then double('nan') else double(i * 37 % 101) end"
    key = {"double": number, "date": "date_add(date'2020-01-01', int(i * 37 % 101))", "string": "string(i * 37 % 101)"}
    df = spark.range(1500).selectExpr("id as i", "concat('k', id) as tie").selectExpr("tie", f"{key[kind]} as key")
    sizes = {"sample_rows": 120, "enclosed_rows": 100}
    actual = add_ntiles(df, "tie", [Ranking("tile", "key", descending)], 5, **sizes)
    order = F.desc_nulls_first("key") if descending else F.asc_nulls_last("key")
    expected = df.withColumn("tile", F.ntile(5).over(Window.orderBy(order, F.asc("tie"))).cast("int"))
    assert {r.tie: r.tile for r in actual.collect()} == {r.tie: r.tile for r in expected.collect()}


def test_ntile_refuses_a_tie_that_tells_nothing_apart(spark):
    df = spark.range(3000).selectExpr("'same' as tie", "1 as key")
    with pytest.raises(ValueError, match="apart"):
        add_ntiles(df, "tie", [Ranking("tile", "key")], 5, sample_rows=120, enclosed_rows=100)


def test_ntile_plan_has_no_window_and_no_shuffle(spark):
    df = add_ntiles(ranked(spark, random_rows(50, 3)), "id", [Ranking("tile", "money")], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


# --- joins --------------------------------------------------------------------------------


def test_salted_join_equals_plain_join(spark):
    facts = spark.createDataFrame(
        [(i, None if i % 7 == 0 else ("hot" if i % 3 else f"k{i % 11}")) for i in range(600)],
        "id int, k string",
    )
    # One key twice in the dimension: its fact rows double, as in any join.
    dimension = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3), ("k3", 4)], "k string, v int")
    salted = joins.salted_left_join(facts, dimension, "k", "id", rows_per_task=20)
    plain = facts.join(dimension, "k", "left")
    assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, plain.select("id", "k", "v").collect()), key=str
    )


def test_frequent_keys_are_spread(spark):
    facts = spark.createDataFrame([(i, "hot" if i else None) for i in range(100)], "id int, k string")
    assert [tuple(r) for r in joins.frequent_keys(facts, "k", 30).collect()] == [("hot", 4)]


def test_left_join_measures_the_dimension(spark):
    dimension = spark.createDataFrame([(f"k{i}", "x" * 100) for i in range(50)], "k string, v string")
    assert joins.fits_broadcast(dimension)
    assert not joins.fits_broadcast(dimension, max_rows=49)
    assert not joins.fits_broadcast(dimension, max_bytes=5000)
    facts = spark.createDataFrame([(1, "k1")], "id int, k string")
    plan = joins.left_join(facts, dimension, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_first_per_key_limits_before_the_shuffle(spark):
    df = materialize(spark.createDataFrame([(i % 3, i) for i in range(50)], "k int, v int"), "dedup")
    first = first_per_key(df, ["k"], ["v"])
    assert sorted(map(tuple, first.collect())) == [(0, 0), (1, 1), (2, 2)]
    assert "Partial" in first._jdf.queryExecution().executedPlan().toString()


# --- checks -------------------------------------------------------------------------------


def test_range_and_values_let_null_pass(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (5,), (6,)], "x int")
    assert [r[0] for r in checks.out_of_range_rows(df, "x", 1, 5).collect()] == [0, 6]
    assert [r[0] for r in checks.out_of_range_rows(df, "x", maximum=5).collect()] == [6]
    assert [r[0] for r in checks.unaccepted_rows(df, "x", [0, 1, 5]).collect()] == [6]
    assert checks.null_rows(df, "x").count() == 1


def test_unique_and_relationships_ignore_null(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    assert [tuple(r) for r in checks.duplicate_keys(child, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.orphan_keys(child, parent, "k").collect()] == [("a", 2)]


@pytest.mark.parametrize("nulls, rows, fails", [(1, 100, False), (2, 100, True), (0, 0, False)])
def test_null_share(spark, nulls, rows, fails):
    df = spark.createDataFrame([(None if i < nulls else i,) for i in range(rows)], "x int")
    assert bool(checks.null_share_above(df, "x").collect()) is fails


def test_stale(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:59:00' as t")
    assert checks.stale(df, "t", 25, "2024-01-02 01:59:00").collect() == []
    assert checks.stale(df, "t", 25, "2024-01-02 02:00:00").first()[0] == 26
    assert checks.stale(df.limit(0), "t", 25, "2024-01-02 02:00:00").collect() == []


@pytest.mark.parametrize(
    "now, status",
    [
        ("2024-01-01 06:00:00", "pass"),
        ("2024-01-01 06:00:01", "warn"),
        ("2024-01-02 00:00:00", "warn"),
        ("2024-01-02 00:00:01", "error"),
    ],
)
def test_source_freshness(spark, now, status):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as _loaded_at")
    assert checks.source_freshness(df, "raw.orders", now=now).first()["status"] == status


def test_source_without_rows_is_not_fresh(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as _loaded_at").limit(0)
    assert checks.source_freshness(df, "raw.orders", now="2024-01-01 00:00:00").first()["status"] == "error"


def test_row_count_growth_is_strict(spark):
    now = spark.createDataFrame([("a", 2), ("b", 3), ("new", 1)], "model string, n_rows long")
    before = spark.createDataFrame([("a", 2), ("b", 2)], "model string, n_rows long")
    assert [tuple(r) for r in checks.row_counts_not_grown(now, before).collect()] == [("a", 2, 2)]


def test_suite_counts_every_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 9), (None, None)], "k string, x int")
    parent = spark.createDataFrame([("z",)], "k string")
    declared = [
        checks.not_null("k"),
        checks.unique("k"),
        checks.accepted_values("k", "b"),
        checks.accepted_range("x", 0, 5),
        checks.relationships("k", to="parent"),
    ]
    result = checks.run_suite(df, "m", declared, {"parent": parent}).collect()
    assert {(r["column_name"], r["check_type"]): r["failures"] for r in result} == {
        ("k", "not_null"): 1,
        ("k", "unique"): 1,
        ("k", "accepted_values"): 2,
        ("x", "accepted_range"): 1,
        ("k", "relationships"): 2,
    }


def test_suites_check_shares_of_null_and_freshness_in_their_scan(spark):
    rows = spark.range(100).select(
        F.when(F.col("id") > 0, F.col("id")).alias("a"), F.when(F.col("id") > 1, F.col("id")).alias("b"),
        F.lit("2024-01-01 00:30:00").cast("timestamp_ntz").alias("t"),
    )
    declared = [
        checks.not_null("a"), checks.not_null_share("a"), checks.not_null_share("b"), checks.fresh("t", 2), checks.fresh("t", 1)
    ]
    suite = checks.run_suite(rows, "m", declared, now="2024-01-01 02:00:00")
    # A share of exactly 1 % passes; the age counts hour boundaries.
    assert [r["failures"] for r in suite.collect()] == [1, 0, 1, 0, 1]
    empty = checks.run_suite(rows.limit(0), "m", declared, now="2024-01-01 02:00:00")
    assert [r["failures"] for r in empty.collect()] == [0, 0, 0, 1, 1]
