"""S8 (re-aimed): live cross-source read.

The reference lets a query engine join its operational databases and the
lakehouse at query time without copying.  The Spark equivalent joins JDBC
DataFrames (or any source frames) with a gold table in one plan: filters
and projections are pushed into each JDBC scan, only the aggregated
open-order rows cross the network, and the gold side is a Parquet scan.

A join's keys do not reach the other database by themselves.  A side that
turns out to have few rows (``most_keys`` and no more; the look stops there)
therefore hands its keys to the other side's WHERE clause as an IN list.
Beyond that the join alone decides.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_STATUSES = ["PLACED", "SHIPPED"]


def few_keys(side: DataFrame, key: str, most: int) -> list | None:
    """The different keys of ``side``, or None if it has more than ``most``
    rows.  Reads no further than one row beyond."""
    rows = side.select(key).limit(most + 1).collect()
    return None if len(rows) > most else sorted({r[0] for r in rows if r[0] is not None})


def among(key: str, keys: list | None) -> Column:
    """A filter sources can take: no bound (None), an IN list, or nothing."""
    return F.lit(True) if keys is None else F.col(key).isin(keys) if keys else F.lit(False)


def live_customer_orders(
    orders_src: DataFrame, customers_src: DataFrame, customer_360: DataFrame, most_keys: int = 0
) -> DataFrame:
    """Per customer with open orders right now: open order count and value
    (source currency amounts), the customer's country and segment from
    the customer system, and lifetime metrics from gold.  With ``most_keys``
    both sources are asked for up to so many keys when this is called."""
    orders_src = orders_src.where(F.col("order_status").isin(OPEN_STATUSES))
    if most_keys:
        orders_src = orders_src.where(among("customer_id", few_keys(customers_src, "customer_id", most_keys)))
        customers_src = customers_src.where(among("customer_id", few_keys(orders_src, "customer_id", most_keys)))
    open_orders = (
        orders_src.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("open_order_count"),
            F.sum("order_total").cast("decimal(22,2)").alias("open_order_total"),
            F.max("order_date").alias("latest_open_order_date"),
        )
    )
    who = customers_src.select("customer_id", "country", "customer_segment")
    lifetime = customer_360.select("customer_id", "lifetime_order_count", "lifetime_revenue_usd")
    return open_orders.join(who, "customer_id", "inner").join(lifetime, "customer_id", "left")
