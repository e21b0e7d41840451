"""Mart state: sums that are kept by silver month and merged into the marts.

``control.sums_by_day``, ``sums_by_customer`` and ``sums_by_product`` hold what
the marts sum, by group and month of the silver rows, one partition for each
month.  After a refresh only the months it rewrote are summed again; a mart is
made from the sums of all months, whose size goes with days, customers and
products rather than with orders or items.  Sums, counts, minima and maxima
merge exactly, so the marts equal those computed from silver.

Like a silver table, a state notes the refreshes it was made from; where they
do not lead to the present ones without a gap, all its months are summed anew.
"""
from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit
from strata.plans import gold, pipeline
from strata.plans.incremental import Refresh, _in
from strata.plans.jobs import side_by_side
from strata.plans.pipeline import COMPUTED_AT, MONTH, PipelineConfig
from strata.sources.store import NULL_PARTITION, TableStore

STATE = "mart_state"
SCHEMA = "mart_sums STRING, made_from STRING, logged_at TIMESTAMP"

Rows = Callable[[str], DataFrame]


def _by_day(rows: Rows) -> DataFrame:
    # An item carries its order's date, so both are in one month.
    sums = gold.daily_sums(rows("orders"), rows("order_items"))
    return sums.withColumn(MONTH, F.date_format("order_date", "yyyy-MM"))


#: name -> (silver tables it sums, sums of some months' rows)
SUMS: dict[str, tuple[list[str], Callable[[Rows], DataFrame]]] = {
    "sums_by_day": (["orders", "order_items"], _by_day),
    "sums_by_customer": (["orders"], lambda rows: gold.customer_sums(rows("orders"), MONTH)),
    "sums_by_product": (["order_items"], lambda rows: gold.sales_by_product(rows("order_items"), MONTH)),
}


def _partition(month: str | None) -> dict[str, str]:
    return {MONTH: NULL_PARTITION if month is None else month}


def refresh_sums(store: TableStore, name: str, silver: dict[str, Refresh]) -> list[str | None] | None:
    """Brings one state up to date; the months summed (None: all)."""
    tables, build = SUMS[name]
    log = store.read_or_empty("control", STATE, SCHEMA).where(F.col("mart_sums") == name)
    row = log.agg(F.max_by("made_from", "logged_at").alias("m")).first()
    made_from = json.loads(row["m"]) if row and row["m"] else {}
    follows = store.exists("control", name) and all(
        silver[t].mode != "rebuilt" and silver[t].before == made_from.get(t) for t in tables
    )
    months = list(dict.fromkeys(m for t in tables for m in silver[t].months)) if follows else None

    def rows(table: str) -> DataFrame:
        df = store.read("silver", table)
        return df if months is None else df.where(_in(MONTH, months))

    if months is None:
        store._delete(store.table_path("control", name))
    if months != []:
        store.append("control", name, build(rows).hint("rebalance", MONTH), [MONTH])
    if months:  # one that lost all its rows is not overwritten by any
        left = {r[0] for r in rows(tables[0]).select(MONTH).distinct().collect()}
        for m in set(months) - left:
            store.drop_partition("control", name, _partition(m))
    note = store.spark.range(1).select(
        F.lit(name).alias("mart_sums"), F.lit(json.dumps({t: silver[t].after for t in tables})).alias("made_from"),
        ts_lit(dt.datetime.now(dt.timezone.utc)).alias("logged_at"),
    )
    store.log(STATE, "mart_sums", name, note)
    return months


def sums(store: TableStore, name: str) -> DataFrame:
    return store.read_or_empty("control", name, store.recorded("control", name))


def marts(store: TableStore, as_of: dt.date) -> dict[str, DataFrame]:
    """The five marts from the states and the good customers and products."""
    day = sums(store, "sums_by_day").drop(MONTH)
    customers = gold.merged_customer_sums(sums(store, "sums_by_customer"))
    sales = gold.merged_sales_by_product(sums(store, "sums_by_product"))
    good = lambda t: pipeline.good_rows(store, t)
    return {
        "daily_sales": gold.daily_sales_of(day),
        "customer_360": gold.customer_360_of(good("customers"), customers, as_of),
        "monthly_revenue": gold.monthly_revenue_of(gold.merged_monthly_sums(day)),
        "inventory_summary": gold.inventory_summary(good("products"), sales),
        "product_performance": gold.product_performance(good("products"), sales),
    }


def refresh_gold(store: TableStore, cfg: PipelineConfig, silver: dict[str, Refresh]) -> dict[str, list[str | None] | None]:
    """States, then marts, each side by side; the months summed by state."""
    as_of, run_ts = cfg.clock()
    spark = store.spark
    summed = side_by_side(spark, {n: (lambda n=n: refresh_sums(store, n, silver)) for n in SUMS})
    side_by_side(
        spark,
        {n: (lambda n=n, df=df: store.replace("gold", n, df.withColumn(COMPUTED_AT, ts_lit(run_ts)))) for n, df in marts(store, as_of).items()},
    )
    return summed
