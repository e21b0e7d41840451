"""The reference's deployment shape end to end: orders, order_items and
customers in a JDBC database (embedded in-memory Derby), products and
exchange rates as CSV files, a second incremental run, and gold equal to
the one-plan marts over the same data."""
import datetime as dt
import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators.dedupe import dedupe_latest
from strata.plans.pipeline import PipelineConfig, run_pipeline
from strata.plans.sources_config import retail_sources
from strata.plans.views import MARTS, RetailLake
from strata.sources import testdata

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
RELAXED = {t: 100.0 for t in ["products", "customers", "exchange_rates", "orders", "order_items"]}


def _csv_dir(df):
    d = os.path.join(tempfile.mkdtemp(prefix="strata-csv-"), "data")
    df.coalesce(1).write.option("header", True).csv(d)
    return d


def test_jdbc_and_csv_sources_through_the_pipeline(spark, store):
    url = f"jdbc:derby:memory:retail{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": DERBY}
    src = lambda v: testdata.source_frame(v)
    orders = src(testdata.orders(spark, SF_SMALL))
    # the operational table has a primary key: keep the dedupe winners
    items = src(
        dedupe_latest(testdata.order_items(spark, SF_SMALL), ["order_item_id"],
                      tie_breakers=testdata.ITEM_TIE_BREAKERS)
    )
    customers = src(testdata.customers(spark, SF_SMALL))
    cutoff = dt.date(1998, 1, 1)

    # first state of the sources: orders before the cutoff
    orders.where(F.col("order_date") < cutoff).write.jdbc(url, "orders", "overwrite", props)
    items.write.jdbc(url, "order_items", "overwrite", props)
    customers.write.jdbc(url, "customers", "overwrite", props)
    products_csv = _csv_dir(src(testdata.products(spark, SF_SMALL)).withColumn(
        "is_active", F.when(F.col("is_active"), "1").otherwise("0")))
    fx_csv = _csv_dir(src(testdata.exchange_rates(spark, SF_SMALL)))

    config = {
        "orders_db": {"url": url, "driver": DERBY, "partitions": 3},
        "customers_db": {"url": url, "driver": DERBY},
        "products_csv": products_csv,
        "exchange_rates_csv": fx_csv,
    }
    cfg = PipelineConfig(as_of=dt.date(2001, 12, 31), run_ts=dt.datetime(2002, 1, 1), thresholds=RELAXED)
    first = run_pipeline(spark, store, retail_sources(json.loads(json.dumps(config))), cfg)
    assert {r.table: r.rows for r in first.bronze}["orders"] == orders.where(F.col("order_date") < cutoff).count()

    # new orders arrive; the second run extracts only those
    orders.where(F.col("order_date") >= cutoff).write.jdbc(url, "orders", "append", props)
    cfg2 = PipelineConfig(as_of=dt.date(2001, 12, 31), run_ts=dt.datetime(2002, 1, 2), thresholds=RELAXED)
    second = run_pipeline(spark, store, retail_sources(config), cfg2)
    by_table = {r.table: r for r in second.bronze}
    assert by_table["orders"].rows == orders.where(F.col("order_date") >= cutoff).count()
    assert by_table["order_items"].rows == 0 and by_table["customers"].rows == 0
    assert by_table["exchange_rates"].rows == 0 and by_table["products"].rows > 0

    lake = RetailLake(spark, SF_SMALL)
    for m in MARTS:
        stored = store.read("gold", m).drop("_gold_computed_at")
        direct = lake.mart(m)
        assert stored.count() == direct.count(), m
        assert stored.exceptAll(direct.select(*stored.columns)).count() == 0, m
