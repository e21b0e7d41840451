"""Stored high-water marks for incremental extraction.

Plain Parquet has no MERGE, so the control table is an append-only log
``(source_table, watermark_value, watermark_type, batch_id, updated_at)``
and the current value of a source is its latest log row (D1 over
``updated_at``, ``batch_id``).  Setting twice therefore shows one value,
the later, exactly like an upsert; the history stays for audits.
Values are stored as text and cast back to the column's type on use.
The log's files are merged from time to time, its rows kept.
"""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata.functions.clock import ts_lit
from strata.operators.dedupe import dedupe_latest
from strata.sources.store import TableStore

TABLE = "watermarks"
SCHEMA = (
    "source_table STRING, watermark_value STRING, watermark_type STRING, "
    "batch_id STRING, updated_at TIMESTAMP"
)


def log(store: TableStore) -> DataFrame:
    return store.read_or_empty("control", TABLE, SCHEMA)


def latest(store: TableStore) -> DataFrame:
    """One row per source_table: its current watermark."""
    return dedupe_latest(log(store), ["source_table"], "updated_at", ["batch_id"])


def current(store: TableStore, source_table: str) -> tuple[str | None, str | None]:
    """(value, batch that set it), or (None, None) before the first
    successful extraction.

    The log is partitioned by ``source_table``, so the filter prunes to
    one directory; the latest entry is a single ``max_by`` aggregate (one
    row to the driver)."""
    if not store.exists("control", TABLE):
        return None, None
    newest = F.struct("updated_at", "batch_id")
    row = (
        log(store)
        .where(F.col("source_table") == source_table)
        .agg(F.max_by(F.struct("watermark_value", "batch_id"), newest).alias("at"))
        .first()
    )
    return (row["at"][0], row["at"][1]) if row and row["at"] else (None, None)


def get_watermark(store: TableStore, source_table: str) -> str | None:
    return current(store, source_table)[0]


def set_watermark(
    store: TableStore,
    source_table: str,
    value: str,
    watermark_type: str = "string",
    batch_id: str | None = None,
    updated_at: dt.datetime | None = None,
) -> None:
    if value is None:
        raise ValueError("a watermark needs a value")
    ts = updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    # one row built in the JVM from literals
    df = store.spark.range(1).select(
        F.lit(source_table).alias("source_table"),
        F.lit(str(value)).alias("watermark_value"),
        F.lit(watermark_type).alias("watermark_type"),
        F.lit(batch_id or uuid.uuid4().hex).alias("batch_id"),
        ts_lit(ts).alias("updated_at"),
    )
    store.log(TABLE, "source_table", source_table, df)


def as_column_literal(value: str, data_type: DataType) -> Column:
    """The stored text as a literal of the watermark column's type."""
    return F.lit(value).cast(data_type)


def since(df: DataFrame, column: str, watermark: str | None) -> DataFrame:
    """Rows strictly past ``watermark`` (all rows when None).

    A DataFrame filter, so Catalyst pushes it into JDBC (WHERE clause),
    Parquet (row-group statistics) or CSV scans -- no SQL text is built.
    """
    if watermark is None:
        return df
    return df.where(F.col(column) > as_column_literal(watermark, df.schema[column].dataType))
