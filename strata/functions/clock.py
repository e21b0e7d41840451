"""Timestamp literals that do not depend on the Python process's zone.

``F.lit(datetime)`` converts a naive datetime with the *process* time
zone; a string cast is read in the *session* time zone (or not at all for
``timestamp_ntz``), which is what every other timestamp in a plan uses.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime, ntz: bool = False) -> Column:
    text = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")
