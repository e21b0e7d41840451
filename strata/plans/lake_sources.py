"""The driver's tables as the five extraction sources (for the end-to-end
run in tests and the bench).  Order items keep their view ordering column
as ``ship_ts`` so silver dedupe can use it as the first tie-breaker."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from strata.plans.bronze import SourceSpec
from strata.plans.pipeline import PipelineConfig
from strata.plans.views import AS_OF, SILVER_TABLES
from strata.sources import testdata

ITEM_DEDUPE = ["ship_ts", *testdata.ITEM_TIE_BREAKERS]
NO_GATE = {t: 100.0 for t in SILVER_TABLES}


def lake_sources(sf_dir: str) -> list[SourceSpec]:
    def src(fn):
        return lambda s: testdata.source_frame(fn(s, sf_dir))

    def items(s: SparkSession) -> DataFrame:
        v = testdata.order_items(s, sf_dir)
        return v.withColumnRenamed("_bronze_ingested_at", "ship_ts").drop("_bronze_source")

    return [
        SourceSpec("orders", "tpch-orders", src(testdata.orders), watermark_col="order_ts"),
        SourceSpec("order_items", "tpch-lineitem", items, watermark_col="order_item_id"),
        SourceSpec("customers", "tpch-customer", src(testdata.customers), watermark_col="customer_id"),
        SourceSpec("products", "tpch-part", src(testdata.products)),
        SourceSpec("exchange_rates", "tpch-fx", src(testdata.exchange_rates), watermark_col="rate_date"),
    ]


def lake_config(run_ts: dt.datetime, gate: bool = True, **kw) -> PipelineConfig:
    extra = {} if gate else {"thresholds": NO_GATE}
    extra.update(kw)
    return PipelineConfig(as_of=AS_OF, run_ts=run_ts, tie_breakers={"order_items": ITEM_DEDUPE}, **extra)
