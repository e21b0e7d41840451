"""Rows that fixed rules break, one rule for each data-quality check.

The values are SQL that Spark and DuckDB both read, so the query and its
oracle break the same rows in the same way: variant ``j`` of a table takes
every row whose number is ``j`` modulo 40, moves it to a key of its own and
puts one wrong value in.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ID = "CAST(NULL AS BIGINT)"
_MINUS = "CAST(-1 AS DECIMAL(10,2))"

# table -> (expression of the row's number, column of the new key, its value, broken values)
BREAKS: dict[str, tuple[str, str, str, list[tuple[str, str]]]] = {
    "customers": ("customer_id", "customer_id", "customer_id + 1000000000", [
        ("customer_id", _ID), ("email", "'broken'"), ("signup_date", "CAST(NULL AS DATE)"),
        ("signup_date", "DATE '2100-01-01'"), ("customer_segment", "'NONE'"),
    ]),
    "products": ("product_id", "product_id", "product_id + 1000000000", [
        ("product_id", _ID), ("product_name", "CAST(NULL AS STRING)"), ("unit_cost", _MINUS),
        ("list_price", _MINUS), ("list_price", "CAST(0 AS DECIMAL(10,2))"),
    ]),
    "exchange_rates": ("day(rate_date)", "quote_currency", "concat('X', quote_currency)", [
        ("rate_date", "CAST(NULL AS DATE)"), ("rate", "CAST(0 AS DECIMAL(12,6))"), ("base_currency", "'XXX'"),
    ]),
    "orders": ("order_id", "order_id", "order_id + 1000000000", [
        ("order_id", _ID), ("customer_id", "CAST(-1 AS BIGINT)"), ("order_status", "'LOST'"),
        ("sales_channel", "'PHONE'"), ("order_total", "CAST(-1 AS DECIMAL(12,2))"), ("currency_code", "'JPY'"),
    ]),
    "order_items": ("order_item_id", "order_item_id", "order_item_id + 1000000000000", [
        ("order_item_id", _ID), ("order_id", "CAST(-1 AS BIGINT)"), ("product_id", "CAST(-1 AS BIGINT)"),
        ("quantity", "0"), ("unit_price", _MINUS),
    ]),
}


def variants(table: str) -> list[tuple[dict[str, str], str]]:
    """(column -> its SQL value, condition on the rows it is made from)."""
    number, key, moved, breaks = BREAKS[table]
    return [({key: moved} | {column: value}, f"{number} % 40 = {j}") for j, (column, value) in enumerate(breaks, start=1)]


def with_broken_rows(view: DataFrame, table: str) -> DataFrame:
    out = view
    for change, which in variants(table):
        out = out.unionByName(view.where(which).withColumns({c: F.expr(v) for c, v in change.items()}))
    return out
