"""B-*: bronze extraction driven by a ``SourceSpec``.

One generic extractor replaces the reference's per-source jobs:

    watermark -> batch log -> scan (+ pushed-down ``col > watermark``)
    -> audit columns -> write (append by ingestion day and batch, or full
    replace) -> new watermark = max over the rows *written* (H1)

The source is read once: row count and new watermark are gathered by an
``Observation`` attached to the write, instead of separate count / max
actions that each re-read the source.  Zero new rows -> nothing written
and the watermark is left unchanged (B-empty).  A batch id names an
interval (see ``strata.sources.batches``): run again, it reads the same
interval into the same partition, so no row is lost or doubled.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strata.operators.audit import BATCH_ID, INGESTED_DATE, add_audit_columns
from strata.sources import batches
from strata.sources import watermark as wm
from strata.sources.store import TableStore

BRONZE_PARTITIONS = [INGESTED_DATE, BATCH_ID]


@dataclass(frozen=True)
class SourceSpec:
    """``table``: bronze table name.  ``source``: ``_bronze_source`` label.
    ``read``: builds the source DataFrame.  ``watermark_col``: None means
    full refresh (K1), else incremental append (K2).  ``overlap``: how far
    behind the watermark to read again to catch late commits (H2), a SQL
    interval (``'1 day'``) or, for a numeric mark, a number; D1 in silver
    drops the repeats.  ``keep_unmarked``: also take rows whose watermark
    column is NULL, on every run -- for files, where a malformed value
    reads as NULL and has to reach the quarantine.  ``filters``: ``read``
    takes a second argument, the filter to apply, and can plan its scan by
    the rows that pass it."""

    table: str
    source: str
    read: Callable[..., DataFrame]
    watermark_col: str | None = None
    overlap: str | None = None
    keep_unmarked: bool = False
    filters: bool = False

    def rows(self, spark: SparkSession, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return self.read(spark, keep) if self.filters else keep(self.read(spark))


@dataclass(frozen=True)
class ExtractResult:
    table: str
    rows: int
    watermark_before: str | None
    watermark_after: str | None
    batch_id: str


def _within(df: DataFrame, spec: SourceSpec, batch: batches.Batch) -> DataFrame:
    """The rows of the batch's interval."""
    if batch.after is None and batch.upto is None:
        return df
    col, kind = F.col(spec.watermark_col), df.schema[spec.watermark_col].dataType
    inside = F.lit(True)
    if batch.after is not None:
        bound = wm.as_column_literal(batch.after, kind)
        if spec.overlap and isinstance(kind, NumericType):
            bound = bound - F.lit(spec.overlap).cast(kind)
        elif spec.overlap:
            bound = bound - F.expr(f"INTERVAL {spec.overlap}")
        inside = col > bound
    if batch.upto is not None:
        inside = inside & (col <= wm.as_column_literal(batch.upto, kind))
    return df.where(inside | col.isNull() if spec.keep_unmarked else inside)


def extract(
    spark: SparkSession,
    store: TableStore,
    spec: SourceSpec,
    run_ts: dt.datetime | None = None,
    batch_id: str | None = None,
) -> ExtractResult:
    if spec.watermark_col is None:
        rows = Observation(f"bronze_{spec.table}")
        df = add_audit_columns(spec.rows(spark, lambda df: df), spec.source, run_ts)
        store.replace("bronze", spec.table, df.observe(rows, F.count(F.lit(1)).alias("rows")))
        return ExtractResult(spec.table, int(rows.get["rows"]), None, None, batch_id or "")

    before, mark_batch = wm.current(store, spec.table)
    day = (run_ts or dt.datetime.now(dt.timezone.utc)).date()

    def settle(other: str, its_day: dt.date) -> str | None:
        rows = store.read("bronze", spec.table).where((F.col(INGESTED_DATE) == F.lit(its_day)) & (F.col(BATCH_ID) == other))
        reached = rows.agg(F.max(spec.watermark_col).cast("string")).first()[0]
        if reached is None or (mark := _max_text(spark, rows, reached, before, spec.watermark_col)) == before:
            return before
        wm.set_watermark(store, spec.table, mark, rows.schema[spec.watermark_col].dataType.simpleString(), other)
        return mark

    batch = batches.open_batch(store, spec.table, batch_id, before, mark_batch, day, settle)
    if batch.after is not None and not batch.repeated:
        before = batch.after
    df = add_audit_columns(spec.rows(spark, lambda df: _within(df, spec, batch)), spec.source, run_ts)
    seen = Observation(f"bronze_{spec.table}_{batch.batch_id}")
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(spec.watermark_col).cast("string").alias("wm")
    )
    existed = store.exists("bronze", spec.table)
    out = observed.withColumn(INGESTED_DATE, F.lit(batch.day)).withColumn(BATCH_ID, F.lit(batch.batch_id))
    store.append("bronze", spec.table, out, BRONZE_PARTITIONS)
    rows, reached = int(seen.get["rows"]), seen.get["wm"]
    if rows == 0 and not existed:
        store.drop_if_empty("bronze", spec.table)
    # Neither an overlap nor a replay may move the watermark back, and a
    # batch without a single mark sets none.
    after = before
    if reached is not None and batch.upto is None:
        after = reached if before is None else _max_text(spark, df, reached, before, spec.watermark_col)
        # logged at wall-clock time (not the logical run time), so the
        # latest entry is always the latest write, also for replays
        wm.set_watermark(store, spec.table, after, str(df.schema[spec.watermark_col].dataType.simpleString()), batch.batch_id)
    batches.commit_batch(store, spec.table, batch, batch.upto if batch.upto is not None else after)
    return ExtractResult(spec.table, rows, before, after, batch.batch_id)


def _max_text(spark: SparkSession, df: DataFrame, a: str, b: str, col: str) -> str:
    """Greater of two stored watermark texts, compared as the column type."""
    t = df.schema[col].dataType
    row = spark.range(1).select(
        F.greatest(F.lit(a).cast(t), F.lit(b).cast(t)).cast("string")
    ).first()
    return row[0]
