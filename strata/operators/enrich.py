"""J1-J4 lookups and C1 currency conversion.

Join strategies are Spark's: a side below ``autoBroadcastJoinThreshold``
(estimated, or measured by AQE after its shuffle) is broadcast, everything
else is a sort-merge join whose skewed probe partitions AQE splits.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USD = "USD"
FX_RATE = "fx_rate_to_usd"


def flag_known(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, flag_col: str) -> DataFrame:
    """Add boolean ``flag_col``: does ``df.left_key`` exist in ``dim.right_key``?

    A left join against the dimension's *distinct* keys, so the probe
    never multiplies rows and reads only the key column.  AQE splits a
    skewed partition only where both sides are freshly shuffled; the keys
    usually arrive partitioned by the dimension's dedupe, so they are
    rebalanced first: a hot key of ``df`` then spans several tasks, for one
    more shuffle of the narrow key column.
    """
    keys = dim.select(F.col(right_key).alias("_probe_key")).distinct().hint("rebalance")
    keys = keys.withColumn("_probe_hit", F.lit(True))
    joined = df.join(keys, df[left_key] == keys["_probe_key"], "left")
    return joined.select(
        *[df[c] for c in df.columns],
        F.coalesce(keys["_probe_hit"], F.lit(False)).alias(flag_col),
    )


def attach(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: Sequence[str | Column],
) -> DataFrame:
    """Left join carrying ``columns`` of ``dim``; ``on`` pairs are
    (df column, dim column).  The dimension must be unique on its keys
    (silver tables are, after D1)."""
    right_names = [r for _, r in on]
    carried = [F.col(c) if isinstance(c, str) else c for c in columns]
    side = dim.select(*[F.col(r).alias(f"_rk_{i}") for i, r in enumerate(right_names)], *carried)
    cond = None
    for i, (left, _) in enumerate(on):
        term = df[left] == side[f"_rk_{i}"]
        cond = term if cond is None else cond & term
    out = df.join(side, cond, "left")
    return out.drop(*[f"_rk_{i}" for i in range(len(on))])


def fx_rate_column(currency_col: str = "currency_code", rate_col: str = "rate") -> Column:
    """USD converts at 1.0; any other currency needs its quoted rate (a
    missing rate stays NULL, which the fx check quarantines)."""
    return F.when(F.col(currency_col) == USD, F.lit(1.0)).otherwise(
        F.col(rate_col).cast("double")
    )


def fx_to_usd(
    df: DataFrame,
    amount_cols: Sequence[str],
    rate_col: str = FX_RATE,
) -> DataFrame:
    """``<amount>_usd = round(amount / rate, 2)`` (double, half-up).

    ``try_divide`` keeps a zero or NULL rate from failing the job under
    ANSI mode; the result is NULL and the row is quarantined.
    """
    return df.withColumns(
        {
            f"{c}_usd": F.round(F.try_divide(F.col(c).cast("double"), F.col(rate_col)), 2)
            for c in amount_cols
        }
    )
