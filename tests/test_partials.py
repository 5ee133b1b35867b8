"""Gold kept up from stored months, against gold built anew."""

import pytest

from stratum.operators import upsert
from stratum.plans import gold, partials
from stratum.plans import silver as silver_plan
from stratum.plans.pipeline import SILVER, PipelineConfig, build_gold, build_silver
from stratum.schemas import SILVER_TYPES
from stratum.sources.layers import LayerStore
from tests.data import customer, customers, order, orders

AS_OF, NOW = "2024-06-01", "2024-02-01 07:00:00"
PEOPLE = [customer("C1"), customer("C2", customer_segment="Consumer"), customer("C3")]


@pytest.fixture
def store(spark, folder):
    return LayerStore(spark, folder)


def load(spark, store, *rows, **config):
    build_silver(spark, orders(spark, *rows), customers(spark, *PEOPLE), store, PipelineConfig(now=NOW, **config))


def rows_of(df):
    return sorted(map(str, df.collect()))


def check(spark, store):
    """Refreshes; both marts must be those of silver as it stands. Returns the months made anew."""
    made = partials.refresh(store, SILVER)
    silver = store.read("silver", SILVER, SILVER_TYPES)
    fresh = gold.mart_revenue_by_segment(silver, "2023-01-01")
    assert rows_of(partials.mart_revenue_by_segment(store, "2023-01-01")) == rows_of(fresh)
    fresh = gold.customer_metrics(silver, AS_OF)
    kept = partials.customer_metrics(store, AS_OF)
    assert kept.dtypes == fresh.dtypes and rows_of(kept) == rows_of(fresh)
    assert made[partials.MONTHLY] == made[partials.CUSTOMERS]
    return made[partials.MONTHLY]


FIRST = [
    order("A", order_date="2023-05-05"),
    order("B", order_date="2023-05-06", customer_id="C2", shipped_date=None),
    order("C", order_date="2023-06-06", unit_price=None),
    order("D", order_date="2023-06-07", quantity="7", discount_pct="12.5"),
]


def late(day):
    return {"_loaded_at": f"2024-01-{day}T06:00:00"}


@pytest.mark.parametrize("partition_by", ["order_month", "order_date"])
def test_only_changed_months_are_made_anew(spark, store, partition_by):
    keep = {"partition_by": partition_by}
    load(spark, store, *FIRST, **keep)
    assert check(spark, store) == {"2023-05-01", "2023-06-01"}
    assert check(spark, store) == set()
    load(spark, store, order("A", order_date="2023-05-05", quantity="9", **late(13)), **keep)  # update
    assert check(spark, store) == {"2023-05-01"}
    load(spark, store, order("C", order_date="2023-07-01", **late(14)), **keep)  # moved to a new month
    assert check(spark, store) == {"2023-06-01", "2023-07-01"}
    load(spark, store, order("E", order_date="2023-08-01", customer_id="C3", **late(15)), **keep)  # insert
    assert check(spark, store) == {"2023-08-01"}
    load(spark, store, order("E", order_date="2023-07-31", **late(16)), **keep)  # the only order of its month leaves
    assert check(spark, store) == {"2023-07-01", "2023-08-01"}


def test_orders_without_a_date_are_a_month_of_their_own(spark, store):
    load(spark, store, *FIRST, order("N", order_date=None, shipped_date=None))
    assert check(spark, store) == {"2023-05-01", "2023-06-01", None}
    load(spark, store, order("N", **late(13)))
    assert check(spark, store) == {None, "2024-01-01"}


def test_the_run_can_keep_gold_up(spark, store):
    config = PipelineConfig(now=NOW, as_of=AS_OF, incremental_gold=True)
    for batch in (FIRST, [order("A", order_date="2023-05-09", **late(13)), order("F", **late(14))]):
        load(spark, store, *batch)
        people = customers(spark, *PEOPLE)
        kept = build_gold(store.read("silver", SILVER, SILVER_TYPES), people, store, config)
        plain = LayerStore(spark, f"{store.root}/plain")
        fresh = build_gold(store.read("silver", SILVER, SILVER_TYPES), people, plain, PipelineConfig(now=NOW, as_of=AS_OF))
        assert {k: rows_of(v) for k, v in kept.items()} == {k: rows_of(v) for k, v in fresh.items()}


@pytest.mark.parametrize("ids,plain", [("AB", True), ("AA", False)])
def test_months_of_unique_orders_take_plain_counts(spark, store, monkeypatch, ids, plain):
    rows = silver_plan.int_orders_enriched(orders(spark, *[order(i) for i in ids]), customers(spark, *PEOPLE), NOW)
    upsert.full_load(rows, store.path("silver", SILVER), SILVER_TYPES, "order_id", "order_month", ["order_date"])
    counts, measures = [], gold._order_measures
    monkeypatch.setattr(gold, "_order_measures", lambda unique: counts.append(unique) or measures(unique))
    partials.refresh(store, SILVER)
    assert counts == [plain]
    found = partials.mart_revenue_by_segment(store, "2023-01-01").collect()
    assert [r.order_count for r in found] == [len(set(ids))]
