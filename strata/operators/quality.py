"""Q1-Q3: named row-level data-quality checks.

A row passes when every condition is TRUE; a NULL condition fails (SQL
``CASE WHEN cond`` takes the ELSE branch).  Failed check names are listed
in check order, comma-joined, in ``_dq_failed_checks``.  The flag is one
``concat_ws`` over ``CASE`` expressions: a single projection inside
whole-stage codegen, no arrays, no extra pass.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED = "_dq_failed_checks"


@dataclass(frozen=True)
class DQCheck:
    """``condition`` is a boolean Column or SQL expression; TRUE = pass."""

    name: str
    condition: Column | str

    def column(self) -> Column:
        c = self.condition
        return F.expr(c) if isinstance(c, str) else c


def _validate(checks: Sequence[DQCheck]) -> None:
    names = [c.name for c in checks]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"duplicate check names: {dupes}")
    bad = [n for n in names if not n or "," in n]
    if bad:
        raise ValueError(f"check names must be non-empty and comma-free: {bad}")


def failed_checks_expr(checks: Sequence[DQCheck]) -> Column:
    """'' when all pass, else the comma-joined names of failed checks."""
    _validate(checks)
    if not checks:
        return F.lit("")
    return F.concat_ws(
        ",", *[F.when(c.column(), F.lit(None)).otherwise(F.lit(c.name)) for c in checks]
    )


def flag_dq(df: DataFrame, checks: Sequence[DQCheck]) -> DataFrame:
    """Add ``_dq_failed_checks`` to every row (one narrow projection)."""
    return df.withColumn(FAILED, failed_checks_expr(checks))


def split_flagged(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the flag column, bad rows with it)."""
    good = flagged.where(F.col(FAILED) == "").drop(FAILED)
    bad = flagged.where(F.col(FAILED) != "")
    return good, bad


def apply_dq_checks(
    df: DataFrame, checks: Sequence[DQCheck]
) -> tuple[DataFrame, DataFrame]:
    """Q2: split into (good, quarantine).  Good keeps the input schema;
    quarantine adds ``_dq_failed_checks``.  Each bad row appears once."""
    return split_flagged(flag_dq(df, checks))


def dq_counts(flagged: DataFrame) -> DataFrame:
    """Q3 as one aggregate: (good, quarantined) counts of a flagged frame."""
    return flagged.agg(
        F.count_if(F.col(FAILED) == "").alias("good"),
        F.count_if(F.col(FAILED) != "").alias("quarantined"),
    )
