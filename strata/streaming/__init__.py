"""Structured Streaming entry points.

The reference has no streams; its incremental extraction is a batch
high-water mark.  For sources that *land files* (a directory that grows),
Spark's own incremental primitive is a file stream run with an
``availableNow`` trigger: the checkpoint remembers which files were read,
so every file is ingested exactly once without a stored watermark.
"""
from strata.streaming.file_ingest import StreamIngestResult, ingest_landed_files

__all__ = ["StreamIngestResult", "ingest_landed_files"]
