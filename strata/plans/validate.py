"""Q7: every gold mart must exist and hold at least one row; all
problems are reported together."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.gold import MARTS
from strata.sources.store import TableStore



class ValidationFailed(RuntimeError):
    pass


def non_empty(name: str, df: DataFrame) -> DataFrame:
    """(mart, has_rows) -- reads at most one row per input partition."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("mart"), (F.col("n") > 0).alias("has_rows")
    )


def validate_frames(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [non_empty(n, df) for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_outputs(store: TableStore, names: Sequence[str] = MARTS) -> list[dict]:
    problems, present = [], {}
    for n in names:
        if store.exists("gold", n):
            present[n] = store.read("gold", n)
        else:
            problems.append(f"{n}: missing")
    rows = []
    if present:
        rows = [r.asDict() for r in validate_frames(present).collect()]
        problems += [f"{r['mart']}: 0 rows" for r in rows if not r["has_rows"]]
    if problems:
        raise ValidationFailed(f"gold validation failed: {problems}")
    return rows
