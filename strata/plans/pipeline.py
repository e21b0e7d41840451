"""Bronze -> silver -> gate -> gold -> validation, as plain calls.

Each silver table is one job: the flagged frame (dedupe, joins, checks) is
written once, good rows and quarantine as two partitions of one version
(clustered by month and business date), with both counts observed on the
write.  A row is in exactly one of them, whatever is recomputed.  Written
silver tables cut the lineage between jobs, so a lost executor only
recomputes the current job's stages.

Jobs that do not need one another run side by side: the extractions, the
dimensions, the marts.  ``incremental`` runs refresh the silver months that
changed and merge the marts from kept sums (``strata.plans.incremental``,
``mart_state``) instead of rebuilding both.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit
from strata.operators.quality import FAILED
from strata.plans import gold, silver
from strata.plans.bronze import ExtractResult, SourceSpec, extract
from strata.plans.checks import GATE_THRESHOLDS_PCT
from strata.plans.gate import dq_gate_observed
from strata.plans.jobs import side_by_side
from strata.plans.validate import validate_outputs
from strata.session import ensure_checkpoint_dir
from strata.sources.store import TableStore

PROCESSED_AT = "_silver_processed_at"
COMPUTED_AT = "_gold_computed_at"
MONTH = "_month"

# table -> (business date column for clustering, key columns)
SILVER_LAYOUT = {
    "products": ("_bronze_ingested_at", ["product_id"]),
    "customers": ("signup_date", ["customer_id"]),
    "exchange_rates": ("rate_date", ["rate_date", "quote_currency"]),
    "orders": ("order_date", ["order_id"]),
    "order_items": ("order_date", ["order_item_id"]),
}


@dataclass
class PipelineConfig:
    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    thresholds: Mapping[str, float] = field(default_factory=lambda: dict(GATE_THRESHOLDS_PCT))
    tie_breakers: Mapping[str, Sequence[str]] = field(default_factory=dict)
    incremental: bool = False

    def clock(self) -> tuple[dt.date, dt.datetime]:
        now = self.run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return (self.as_of or now.date()), now


@dataclass
class PipelineResult:
    bronze: list[ExtractResult]
    silver: dict[str, tuple[int, int]]
    gate: list[dict]
    gold: list[dict]


def write_silver(
    store: TableStore, name: str, result: silver.Silver, run_ts: dt.datetime
) -> tuple[int, int]:
    """K3 + K4 in one pass: (good, quarantined) rows."""
    date_col, _ = SILVER_LAYOUT[name]
    counts = Observation(f"silver_{name}")
    flagged = (
        result.flagged.withColumn(PROCESSED_AT, ts_lit(run_ts))
        .withColumn("_good", F.col(FAILED) == "")
        .withColumn(MONTH, F.date_format(F.col(date_col), "yyyy-MM"))
    )
    # Rebalancing by (good, month) puts a month into few files; AQE splits a
    # month that holds a third of the rows and merges small ones, from the
    # sizes it has measured, so nothing below runs a second time.  Each file
    # is sorted by date for row-group pruning.
    clustered = (
        flagged.hint("rebalance", "_good", MONTH)
        .sortWithinPartitions("_good", MONTH, date_col)
        .observe(counts, F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    )
    store.replace_split(name, clustered, "_good", FAILED, [MONTH])
    return int(counts.get["good"]), int(counts.get["bad"])


def read_silver_between(
    store: TableStore, name: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Silver rows whose business date is in ``[start, end]``.

    The date predicate alone cannot prune the month directories, so the
    matching ``_month`` range is added: Spark then lists and reads only
    those partitions (``PartitionFilters`` in the plan), and the sorted
    files let row-group statistics skip the rest of the edge months."""
    date_col, _ = SILVER_LAYOUT[name]
    df = store.read("silver", name)
    return df.where(
        F.col(MONTH).between(start.strftime("%Y-%m"), end.strftime("%Y-%m"))
        & F.col(date_col).between(F.lit(start), F.lit(end))
    )


def _bronze(store: TableStore, name: str) -> DataFrame:
    return store.read("bronze", name)


def good_rows(store: TableStore, name: str) -> DataFrame:
    return store.read("silver", name).drop(PROCESSED_AT, MONTH)


_good = good_rows


def build_silver(store: TableStore, name: str, cfg: PipelineConfig, bronze: DataFrame | None = None) -> silver.Silver:
    """One silver table from bronze (all of it unless given) and the stored
    silver tables it looks up."""
    as_of, _ = cfg.clock()
    bronze, ties = _bronze(store, name) if bronze is None else bronze, cfg.tie_breakers.get(name, ())
    if name == "customers":
        return silver.silver_customers(bronze, as_of, ties)
    if name == "products":
        return silver.silver_products(bronze, ties)
    if name == "exchange_rates":
        return silver.silver_exchange_rates(bronze, ties)
    if name == "orders":
        return silver.silver_orders(bronze, _good(store, "customers"), _good(store, "exchange_rates"), ties)
    return silver.silver_order_items(bronze, _good(store, "orders"), _good(store, "products"), ties)


def run_silver(store: TableStore, cfg: PipelineConfig, names: Sequence[str] = tuple(SILVER_LAYOUT)) -> dict[str, tuple[int, int]]:
    """Rebuilds the named tables, dimensions (side by side) before the facts
    that probe them."""
    _, run_ts = cfg.clock()
    done: dict[str, tuple[int, int]] = {}
    for step in (["products", "customers", "exchange_rates"], ["orders"], ["order_items"]):
        jobs = {n: (lambda n=n: write_silver(store, n, build_silver(store, n, cfg), run_ts)) for n in step if n in names}
        done |= side_by_side(store.spark, jobs)
    return {n: done[n] for n in SILVER_LAYOUT if n in done}


def build_marts(store: TableStore, as_of: dt.date, names: Sequence[str] = tuple(gold.MARTS)) -> dict[str, DataFrame]:
    """The named marts from the stored silver tables."""
    sales = None
    if {"inventory_summary", "product_performance"} & set(names):
        sales = gold.sales_by_product(_good(store, "order_items"))
        if len({"inventory_summary", "product_performance"} & set(names)) == 2:
            # It feeds two marts: one scan of the items, one row per product
            # kept in the shared checkpoint folder.
            ensure_checkpoint_dir(store.spark)
            sales = sales.checkpoint(eager=True)
    build = {
        "daily_sales": lambda: gold.daily_sales(_good(store, "orders"), _good(store, "order_items")),
        "customer_360": lambda: gold.customer_360(_good(store, "customers"), _good(store, "orders"), as_of),
        "monthly_revenue": lambda: gold.monthly_revenue(_good(store, "orders")),
        "inventory_summary": lambda: gold.inventory_summary(_good(store, "products"), sales),
        "product_performance": lambda: gold.product_performance(_good(store, "products"), sales),
    }
    return {name: build[name]() for name in gold.MARTS if name in names}


def run_gold(store: TableStore, cfg: PipelineConfig, names: Sequence[str] = tuple(gold.MARTS)) -> None:
    as_of, run_ts = cfg.clock()
    side_by_side(
        store.spark,
        {
            name: (lambda name=name, df=df: store.replace("gold", name, df.withColumn(COMPUTED_AT, ts_lit(run_ts))))
            for name, df in build_marts(store, as_of, names).items()
        },
    )


def run_pipeline(
    spark: SparkSession,
    store: TableStore,
    sources: Sequence[SourceSpec],
    cfg: PipelineConfig | None = None,
    batch_id: str | None = None,
) -> PipelineResult:
    """Bronze (all sources) -> silver (dimensions, then orders, then
    items) -> gate (raises ``GateFailed`` before any gold write) -> gold
    -> validation (raises ``ValidationFailed``).  ``batch_id`` names the
    batches of this run's extractions."""
    cfg = cfg or PipelineConfig()
    if cfg.run_ts is None:  # one clock for all jobs of the run
        cfg = replace(cfg, run_ts=cfg.clock()[1])
    _, run_ts = cfg.clock()
    store.ensure_layers()
    bronze = side_by_side(
        spark, {s.table: (lambda s=s: extract(spark, store, s, run_ts=run_ts, batch_id=batch_id)) for s in sources}
    )
    if cfg.incremental:
        from strata.plans import incremental, mart_state

        refreshed = incremental.refresh_silver(store, cfg)
        counts = {n: (r.good, r.bad) for n, r in refreshed.items()}
    else:
        counts = run_silver(store, cfg)
    gate = dq_gate_observed(spark, counts, cfg.thresholds)
    if cfg.incremental:
        mart_state.refresh_gold(store, cfg, refreshed)
    else:
        run_gold(store, cfg)
    checked = validate_outputs(store)
    return PipelineResult(list(bronze.values()), counts, gate, checked)
