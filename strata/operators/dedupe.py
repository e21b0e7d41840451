"""Keep the latest row per business key.

``row_number() over (partition by key order by order_col desc, ...) = 1``.
Spark 3.5+ plans this as a partial ``WindowGroupLimit`` before the
shuffle and a final one after it, so a hot key contributes at most one
row per map partition to the exchange: a key holding a third of all rows
does not land whole in one task.

Differences from a bare row_number, all opt-in:

* ``tie_breakers`` make the winner deterministic when rows share the
  order value (rows of one bronze batch share one timestamp).  Without
  them a recomputed task after an executor loss could pick another row.
* ``quarantine_null_keys``: rows whose key is NULL would all collapse
  into one group (and one task).  Callers that quarantine NULL keys
  anyway split them off before the window; see ``split_null_keys``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.audit import INGESTED_AT

_RN = "_dedupe_rn"


def _desc(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last()


def dedupe_latest(
    df: DataFrame,
    key_cols: Sequence[str],
    order_col: str = INGESTED_AT,
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per ``key_cols``: the greatest ``order_col`` (NULLs last),
    then the greatest ``tie_breakers`` in order.  NULL keys form one group
    (SQL window semantics)."""
    if not key_cols:
        raise ValueError("dedupe_latest needs at least one key column")
    w = Window.partitionBy(*key_cols).orderBy(
        _desc(order_col), *[_desc(t) for t in tie_breakers]
    )
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def split_null_keys(df: DataFrame, key_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with some key NULL)."""
    any_null = F.lit(False)
    for k in key_cols:
        any_null = any_null | F.col(k).isNull()
    return df.where(~any_null), df.where(any_null)
