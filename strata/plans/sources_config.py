"""The five retail sources as ``SourceSpec``s, built from a config.

Config (JSON/dict); credentials are read from the environment variables
the config names, never stored in it::

    {
      "orders_db":    {"url": "jdbc:postgresql://host:5432/orders_db",
                       "driver": "org.postgresql.Driver",
                       "user_env": "ORDERS_USER", "password_env": "ORDERS_PASSWORD",
                       "partitions": 64},
      "customers_db": {"url": "jdbc:mysql://host:3306/customers_db",
                       "driver": "com.mysql.cj.jdbc.Driver",
                       "user_env": "CUSTOMERS_USER", "password_env": "CUSTOMERS_PASSWORD"},
      "products_csv": "hdfs:///landing/products.csv",
      "exchange_rates_csv": "hdfs:///landing/exchange_rates.csv"
    }

--- Fixed values (as the reference) ---
watermark columns: orders order_ts, order_items order_item_id,
                   customers customer_id, exchange_rates rate_date;
                   products: full refresh
source labels:     postgres-orders, mysql-customers, products-csv,
                   exchange-rates-csv
--- end of fixed values ---
"""
from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.bronze import SourceSpec
from strata.sources import files, jdbc

# table -> (connection key, watermark column, numeric split column)
JDBC_TABLES = {
    "orders": ("orders_db", "order_ts", "order_id"),
    "order_items": ("orders_db", "order_item_id", "order_item_id"),
    "customers": ("customers_db", "customer_id", "customer_id"),
}
LABELS = {
    "orders_db": "postgres-orders",
    "customers_db": "mysql-customers",
    "products": "products-csv",
    "exchange_rates": "exchange-rates-csv",
}


def _props(conn: Mapping) -> dict[str, str]:
    props = {"driver": conn["driver"]} if conn.get("driver") else {}
    if conn.get("user_env"):
        props["user"] = os.environ.get(conn["user_env"], "")
    if conn.get("password_env"):
        props["password"] = os.environ.get(conn["password_env"], "")
    return props


def _actual(df: DataFrame, column: str) -> str:
    """The source's spelling of a column (databases differ in case)."""
    for c in df.columns:
        if c.lower() == column.lower():
            return c
    raise KeyError(column)


#: Rank error of the stride boundaries: one in so many rows.
ACCURACY = 10_000


def jdbc_bounds(df: DataFrame, column: str) -> tuple:
    """(min, max) of a numeric column over the rows of ``df``."""
    row = df.agg(F.min(column), F.max(column)).first()
    return row[0], row[1]


def quantile_strides(df: DataFrame, column: str, parts: int) -> list:
    """Increasing boundaries that cut the rows of ``df`` into about equal
    parts; few where a value holds more than a part's rows."""
    at = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], ACCURACY)).first()[0]
    return sorted(set(at or []))


def stride_predicates(column: str, bounds: list) -> list[str]:
    """WHERE clauses of the parts: a row is in exactly one, null in the first."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} <= {bounds[0]} OR {column} IS NULL", *inner, f"{column} > {bounds[-1]}"]


def _jdbc_reader(conn: Mapping, table: str, split_col: str):
    """``read(spark, keep)``: the rows that ``keep`` (frame -> filtered
    frame) lets through, read in parallel.  The strides divide the rows that
    are wanted, not the table, and by their quantiles, not by the width of
    their range: the split column alone is read first, in strides of equal
    width, and gaps or clusters of its values leave no long stride."""

    def read(spark: SparkSession, keep=lambda df: df) -> DataFrame:
        props = _props(conn)
        whole = jdbc.jdbc_scan(spark, conn["url"], table, props)
        parts = int(conn.get("partitions", 0) or 0)
        if parts > 1:
            column = _actual(whole, split_col)
            lo, hi = jdbc_bounds(keep(lowercase_columns(whole)), split_col)
            if lo is not None and hi is not None and hi > lo:
                even = jdbc.jdbc_scan(
                    spark, conn["url"], table, props, partition_column=column,
                    lower_bound=int(lo), upper_bound=int(hi) + 1, num_partitions=parts,
                )
                bounds = quantile_strides(keep(lowercase_columns(even)), split_col, parts)
                quoted = jdbc.quoted(spark, conn["url"], column)
                whole = jdbc.jdbc_scan(spark, conn["url"], table, props, predicates=stride_predicates(quoted, bounds))
        return keep(lowercase_columns(whole))

    return read


def retail_sources(config: Mapping) -> list[SourceSpec]:
    specs = []
    for table, (conn_key, wm_col, split_col) in JDBC_TABLES.items():
        if conn_key in config:
            specs.append(
                SourceSpec(table, LABELS[conn_key], _jdbc_reader(config[conn_key], table, split_col),
                           watermark_col=wm_col, overlap=config.get("overlap", {}).get(table), filters=True)
            )
    if "products_csv" in config:
        products_path = config["products_csv"]
        specs.append(
            SourceSpec("products", LABELS["products"],
                       lambda s, p=products_path: files.products_csv(s, p))
        )
    if "exchange_rates_csv" in config:
        fx_path = config["exchange_rates_csv"]
        specs.append(
            SourceSpec("exchange_rates", LABELS["exchange_rates"],
                       lambda s, p=fx_path: files.exchange_rates_csv(s, p), watermark_col="rate_date",
                       keep_unmarked=True)
        )
    return specs


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Some databases (Derby, Oracle) return upper-case column names."""
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
