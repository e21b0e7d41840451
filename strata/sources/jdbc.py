"""JDBC scans.

The reference builds ``(SELECT * FROM t WHERE col > 'v') AS t`` strings;
here the scan is a plain table read and the watermark is a DataFrame
filter (``watermark.since``), which Catalyst pushes into the database's
WHERE clause (``PushedFilters`` in the plan) with proper literal typing.
Parallel reads: pass ``partition_column`` + bounds + ``num_partitions``
(range-split on a numeric/date column) or explicit ``predicates``;
without them Spark reads the table in one task.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int | None = 10_000,
) -> DataFrame:
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("pushDownAggregate", "true")
    )
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if fetch_size:
        reader = reader.option("fetchsize", str(fetch_size))
    if predicates:
        # same options as a plain scan; the predicates make the partitions
        options = {**(properties or {}), "pushDownAggregate": "true"}
        if fetch_size:
            options["fetchsize"] = str(fetch_size)
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def quoted(spark: SparkSession, url: str, column: str) -> str:
    """The column's name as the database of ``url`` wants it in SQL text."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
