"""Dense rank within a group, descending, with no group in one task.

``dense_rank() over (partition by g order by v desc)`` sends every row of
a group to one task; a group holding a third of all rows would make that
task the whole job.  Here a group's values fall into buckets that keep
their order (64 for each doubling of the value), and:

1. ``distinct (g, v)``: a grouped aggregate (map-side combined), so
   repeated values collapse before any shuffle; the dense rank of ``v``
   is its row number among the distinct values of ``g``.
2. Local row number within ``(g, bucket)`` plus an offset: the number of
   distinct values of ``g`` in higher buckets, from a running sum over the
   small ``(g, bucket) -> count`` table.
3. Join the ranks back on ``(g, v)``.

The buckets are a function of the value alone, so the plan is lazy and
every recomputation of a task gives the same ranks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _LOCAL, _CNT, _OFF = "_rank_bucket", "_rank_local", "_rank_cnt", "_rank_off"
BUCKETS_PER_DOUBLING = 64


def value_bucket(value: Column) -> Column:
    """An integer that never falls as the (numeric) value rises; NULL for NULL."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v) + 1) * BUCKETS_PER_DOUBLING)
    return F.when(v < 0, -size - 1).otherwise(size).cast("int")


def dense_rank_desc(df: DataFrame, group_col: str, value_col: str, out_col: str) -> DataFrame:
    """Dense rank of the numeric ``value_col`` (descending, NULLs last)
    within ``group_col`` (NULLs are a group)."""
    g, v = F.col(group_col), F.col(value_col)
    values = df.select(group_col, value_col).distinct().withColumn(_BUCKET, value_bucket(v))
    local = values.withColumn(
        _LOCAL, F.row_number().over(Window.partitionBy(group_col, _BUCKET).orderBy(v.desc_nulls_last()))
    )
    counts = values.groupBy(g.alias("_off_g"), F.col(_BUCKET).alias("_off_b")).agg(F.count(F.lit(1)).alias(_CNT))
    higher = Window.partitionBy("_off_g").orderBy(F.col("_off_b").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(_OFF, F.coalesce(F.sum(_CNT).over(higher), F.lit(0))).drop(_CNT)
    ranks = local.join(
        offsets, g.eqNullSafe(F.col("_off_g")) & F.col(_BUCKET).eqNullSafe(F.col("_off_b"))
    ).select(
        g.alias("_rk_g"), v.alias("_rk_v"), (F.col(_OFF) + F.col(_LOCAL)).cast("int").alias(out_col)
    )
    cond = df[group_col].eqNullSafe(ranks["_rk_g"]) & df[value_col].eqNullSafe(ranks["_rk_v"])
    return df.join(ranks, cond, "left").drop("_rk_g", "_rk_v")
