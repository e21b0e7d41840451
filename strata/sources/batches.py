"""The interval every bronze batch covers, logged before it is read.

``control.batches`` is an append-only log, one directory per source table:
a batch is *started* with the watermark it reads from and its day, and
*committed* with the watermark it reached.  That makes a batch repeatable:

* a batch that did not commit is taken up again under its own id.  When the
  next run brings an id of its own, it depends on where the job died: before
  its watermark, its partition is dropped and it is *abandoned* (the next
  batch reads those rows); after it, its rows are whole and the next batch
  begins behind them, so it is committed;
* a committed batch asked for again re-reads from where it began, up to
  where it ended -- or, while it is still the latest, up to the newest row,
  so rows that arrived since join it; that is a start again, and if it dies
  before it commits, the watermark follows the rows its partition holds;
* its day is the day of its first attempt, so a replay after midnight
  rewrites the same partition.

One writer per source table, as everywhere in the store.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit
from strata.operators.audit import BATCH_ID, INGESTED_DATE
from strata.sources.store import TableStore

TABLE = "batches"
SCHEMA = (
    "source_table STRING, batch_id STRING, status STRING, from_value STRING, "
    "to_value STRING, ingested_date DATE, logged_at TIMESTAMP"
)
STARTED, COMMITTED, ABANDONED = "started", "committed", "abandoned"


@dataclass(frozen=True)
class Batch:
    """Rows past ``after`` (all when None), up to ``upto`` (open when None)."""

    batch_id: str
    after: str | None
    upto: str | None
    day: dt.date
    repeated: bool


def log(store: TableStore):
    return store.read_or_empty("control", TABLE, SCHEMA)


def _note(store: TableStore, table: str, status: str, batch_id: str, after, upto, day: dt.date) -> None:
    row = store.spark.range(1).select(
        F.lit(table).alias("source_table"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(status).alias("status"),
        F.lit(after).cast("string").alias("from_value"),
        F.lit(upto).cast("string").alias("to_value"),
        F.lit(day).alias("ingested_date"),
        ts_lit(dt.datetime.now(dt.timezone.utc)).alias("logged_at"),
    )
    store.log(TABLE, "source_table", table, row)


def open_batch(
    store: TableStore,
    table: str,
    batch_id: str | None,
    mark: str | None,
    mark_batch: str | None,
    day: dt.date,
    settle: Callable[[str, dt.date], str | None],
) -> Batch:
    """The batch to run now; ``mark`` is the current watermark and
    ``mark_batch`` the batch that set it.  ``settle`` moves the watermark to
    the last row of a batch's partition and returns it."""
    own = F.col("status") == STARTED
    # What came before a batch was abandoned is over.
    lost = F.max(F.when(F.col("status") == ABANDONED, F.col("logged_at"))).over(Window.partitionBy("batch_id"))
    states = (
        log(store)
        .where(F.col("source_table") == table)
        .withColumn("lost", lost)
        .where("lost IS NULL OR logged_at >= lost")
        .groupBy("batch_id")
        .agg(
            F.min_by("from_value", F.when(own, F.col("logged_at"))).alias("after"),
            F.min_by("ingested_date", F.when(own, F.col("logged_at"))).alias("day"),
            F.min(F.when(own, F.col("logged_at"))).alias("begun"),
            F.max_by("to_value", F.when(F.col("status") == COMMITTED, F.col("logged_at"))).alias("upto"),
            F.max_by("status", "logged_at").alias("status"),
        )
        # unfinished ones (one, unless jobs died in a row) and the asked one
        .where((F.col("status") == STARTED) | (F.col("batch_id") == F.lit(batch_id)))
        .orderBy("begun")
        .collect()
    )
    known = {r["batch_id"]: r for r in states}
    unfinished = [r["batch_id"] for r in states if r["status"] == STARTED]
    if batch_id is None:
        batch_id = unfinished[-1] if unfinished else uuid.uuid4().hex[:12]
    for other in unfinished:
        if other == batch_id:
            continue
        r = known[other]
        if other == mark_batch:
            mark = settle(other, r["day"])
            _note(store, table, COMMITTED, other, r["after"], mark, r["day"])
        else:
            store.drop_partition("bronze", table, {INGESTED_DATE: r["day"].isoformat(), BATCH_ID: other})
            _note(store, table, ABANDONED, other, r["after"], None, r["day"])
    again = known.get(batch_id)
    if again is None or again["status"] == ABANDONED:
        _note(store, table, STARTED, batch_id, mark, None, day)
        return Batch(batch_id, mark, None, day, False)
    closed = again["status"] == COMMITTED and mark_batch != batch_id
    if again["status"] == COMMITTED and not closed:
        _note(store, table, STARTED, batch_id, again["after"], None, again["day"])
    return Batch(batch_id, again["after"], again["upto"] if closed else None, again["day"], True)


def commit_batch(store: TableStore, table: str, batch: Batch, upto: str | None) -> None:
    _note(store, table, COMMITTED, batch.batch_id, batch.after, upto, batch.day)


def note_streamed(store: TableStore, table: str, batch_id: str, day: dt.date) -> None:
    """A batch a stream has written; the stream keeps its interval itself."""
    _note(store, table, COMMITTED, batch_id, None, None, day)
