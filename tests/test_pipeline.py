"""End to end: bronze extraction from the driver's tables -> silver ->
gate -> gold -> validation, and the stored marts equal the one-plan marts."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans.lake_sources import lake_config, lake_sources
from strata.plans.gate import GateFailed
from strata.plans.pipeline import run_pipeline
from strata.plans.views import MARTS, RetailLake

RUN = dt.datetime(2002, 1, 1, 6, 0, 0)


def sources(sf_dir):
    return lake_sources(sf_dir)


def config(**kw):
    return lake_config(RUN, **kw)


def test_gate_blocks_gold(spark, store):
    with pytest.raises(GateFailed) as e:
        run_pipeline(spark, store, sources(SF_SMALL), config())
    assert "orders:" in str(e.value)
    for m in MARTS:
        assert not store.exists("gold", m)
    assert store.exists("silver", "orders") and store.exists("quarantine", "orders")


def test_full_run_matches_single_plan_marts(spark, store):
    relaxed = {t: 100.0 for t in ["products", "customers", "exchange_rates", "orders", "order_items"]}
    result = run_pipeline(spark, store, sources(SF_SMALL), config(thresholds=relaxed))
    assert {r["mart"] for r in result.gold} == set(MARTS)
    lake = RetailLake(spark, SF_SMALL)
    for m in MARTS:
        stored = store.read("gold", m).drop("_gold_computed_at")
        direct = lake.mart(m)
        assert stored.count() == direct.count()
        assert stored.exceptAll(direct.select(*stored.columns)).count() == 0, m
    # silver is partitioned by month and carries the processing stamp
    orders = store.read("silver", "orders")
    assert "_month" in orders.columns and orders.select(F.min("_silver_processed_at")).first()[0] == RUN
    good, bad = result.silver["orders"]
    assert good + bad == store.read("bronze", "orders").count()


def _retail(orders):
    """The five sources with these orders, an item each."""
    import fixtures as fx
    from strata.plans.bronze import SourceSpec

    def source(table, schema, rows, mark):
        read = lambda s: fx.frame(s, schema, rows).drop("_bronze_ingested_at", "_bronze_source")
        return SourceSpec(table, "test", read, watermark_col=mark)

    items = [fx.item(o["order_id"] * 10, oid=o["order_id"], total="100.00", price="100.00") for o in orders]
    return [
        source("customers", fx.CUSTOMERS, [fx.customer(i) for i in range(1, 4)], "customer_id"),
        source("products", fx.PRODUCTS, [fx.product(1), fx.product(2)], None),
        source("exchange_rates", fx.FX, [fx.fx("EUR", "0.92")], "rate_date"),
        source("orders", fx.ORDERS, orders, "order_id"),
        source("order_items", fx.ITEMS, items, "order_item_id"),
    ]


def test_a_run_passes_the_real_thresholds_and_a_worse_one_leaves_gold_alone(spark, store):
    import fixtures as fx
    from strata.plans.pipeline import PipelineConfig

    good = [fx.order(i, cid=1 + i % 3) for i in range(1, 400)] + [fx.order(400, cid=99)]
    cfg = lambda day: PipelineConfig(as_of=dt.date(2026, 1, day), run_ts=dt.datetime(2026, 1, day))
    result = run_pipeline(spark, store, _retail(good), cfg(10))
    assert result.silver["orders"] == (399, 1) and result.silver["order_items"] == (399, 1)
    assert {r["mart"] for r in result.gold} == set(MARTS)
    sales = store.read("gold", "daily_sales").drop("_gold_computed_at").collect()
    assert len(sales) >= 1
    before = {m: store.current_path("gold", m) for m in MARTS}

    with pytest.raises(GateFailed) as e:
        run_pipeline(spark, store, _retail(good + [fx.order(i, cid=99) for i in range(401, 411)]), cfg(11))
    assert "orders:" in str(e.value)
    assert {m: store.current_path("gold", m) for m in MARTS} == before
    assert store.read("quarantine", "orders").count() == 11
