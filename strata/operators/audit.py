"""Bronze audit columns."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit

INGESTED_AT = "_bronze_ingested_at"
SOURCE = "_bronze_source"
INGESTED_DATE = "_bronze_ingested_date"
BATCH_ID = "_batch_id"


def add_audit_columns(
    df: DataFrame, source: str, run_ts: dt.datetime | Column | None = None
) -> DataFrame:
    """Stamp ingestion time and source name.

    ``run_ts`` pins the clock (tests, replays); default is the query's
    ``current_timestamp()``, which Spark evaluates once per query so every
    row of a batch shares it.
    """
    if run_ts is None:
        ts = F.current_timestamp()
    elif isinstance(run_ts, Column):
        ts = run_ts
    else:
        ts = ts_lit(run_ts)
    return df.withColumns({INGESTED_AT: ts, SOURCE: F.lit(source)})


def add_ingested_date(df: DataFrame) -> DataFrame:
    """Ingestion day, the bronze partition column."""
    return df.withColumn(INGESTED_DATE, F.to_date(F.col(INGESTED_AT)))
