"""Bronze ingestion of landed files with Structured Streaming.

``readStream`` over the landing directory -> audit columns -> one bronze
append per micro-batch via ``foreachBatch`` -> ``trigger(availableNow)``
processes everything that arrived since the last run and stops.

Exactly once: the stream checkpoint (on the store's shared storage)
records the files each micro-batch took; the bronze write partitions by
day and ``_batch_id = <stream id>-<epoch>`` with dynamic partition
overwrite, so an epoch replayed after a failure replaces its own rows
instead of adding them twice.  The stream id is drawn when a checkpoint is
new and kept in it, so two streams, or one that lost its checkpoint, never
share a batch id; the day of an epoch is kept there too, so a replay after
midnight rewrites the same partition.  ``maxFilesPerTrigger`` bounds each
micro-batch.  Two streams into one table need two checkpoints.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.audit import BATCH_ID, INGESTED_DATE, add_audit_columns
from strata.plans.bronze import BRONZE_PARTITIONS
from strata.sources import batches
from strata.sources.store import TableStore


@dataclass(frozen=True)
class StreamIngestResult:
    table: str
    rows: int
    batches: int


def ingest_landed_files(
    spark: SparkSession,
    store: TableStore,
    table: str,
    source_label: str,
    landing_dir: str,
    schema: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> StreamIngestResult:
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = spark.readStream.format(fmt).schema(schema).options(**opts).load(landing_dir)
    if transform is not None:
        stream = transform(stream)

    location = checkpoint or f"{store.root}/_streams/{table}"
    stream_id = store.remember(f"{location}/strata/stream", uuid.uuid4().hex[:12])
    taken: dict[int, int] = {}

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        today = dt.datetime.now(dt.timezone.utc).date().isoformat()
        day = store.remember(f"{location}/strata/day-{epoch_id:010d}", today)
        rows = Observation(f"{stream_id}_{epoch_id}_{uuid.uuid4().hex[:6]}")
        out = (
            add_audit_columns(batch, source_label)
            .observe(rows, F.count(F.lit(1)).alias("n"))
            .withColumn(INGESTED_DATE, F.lit(day).cast("date"))
            .withColumn(BATCH_ID, F.lit(f"{stream_id}-{epoch_id:010d}"))
        )
        store.append("bronze", table, out, BRONZE_PARTITIONS)
        batches.note_streamed(store, table, f"{stream_id}-{epoch_id:010d}", dt.date.fromisoformat(day))
        taken[epoch_id] = int(rows.get["n"])

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .queryName(f"ingest_{table}")
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return StreamIngestResult(table, sum(taken.values()), sum(1 for n in taken.values() if n))
