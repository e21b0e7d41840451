"""Silver and gold computed straight from the driver's tables, as one
lazy plan per query (what ``queries()`` registers)."""
from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.plans import gold, silver
from strata.sources import testdata

# Fixed clock for reproducible results on the driver's tables: all of
# their dates end before it.
AS_OF = dt.date(2001, 12, 31)


class RetailLake:
    """Bronze views -> silver splits -> gold marts, lazily.  Marts that sum
    per order, customer or product take their rows before the look-up of
    that same key and join the other side's good rows after the sum, so a
    hot key is one row by the time it is joined."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return testdata.bronze_views(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> silver.Silver:
        return silver.silver_customers(self.bronze["customers"], self.as_of)

    @cached_property
    def products(self) -> silver.Silver:
        return silver.silver_products(self.bronze["products"])

    @cached_property
    def exchange_rates(self) -> silver.Silver:
        return silver.silver_exchange_rates(self.bronze["exchange_rates"])

    def _orders(self, customers: DataFrame | None) -> silver.Silver:
        return silver.silver_orders(self.bronze["orders"], customers, self.exchange_rates.good)

    def _items(self, orders: DataFrame | None, products: DataFrame | None) -> silver.Silver:
        return silver.silver_order_items(
            self.bronze["order_items"], orders, products, testdata.ITEM_TIE_BREAKERS,
            null_keyed=testdata.order_items_without_key(self.spark, self.sf_dir),
        )

    @cached_property
    def orders(self) -> silver.Silver:
        return self._orders(self.customers.good)

    @cached_property
    def order_items(self) -> silver.Silver:
        return self._items(self.orders.good, self.products.good)

    @cached_property
    def sales_by_product(self) -> DataFrame:
        """Sums of the items whose order is good; the marts join the good products."""
        return gold.sales_by_product(self._items(self.orders.good, None).good)

    def silver(self, name: str) -> silver.Silver:
        return getattr(self, name)

    def daily_sales(self) -> DataFrame:
        # The join with the good orders stands for the items' order check.
        return gold.daily_sales(self.orders.good, self._items(None, self.products.good).good)

    def customer_360(self) -> DataFrame:
        # The join with the good customers stands for the orders' customer check.
        return gold.customer_360(self.customers.good, self._orders(None).good, self.as_of)

    def monthly_revenue(self) -> DataFrame:
        return gold.monthly_revenue(self.orders.good)

    def inventory_summary(self) -> DataFrame:
        return gold.inventory_summary(self.products.good, self.sales_by_product)

    def product_performance(self) -> DataFrame:
        return gold.product_performance(self.products.good, self.sales_by_product)

    def mart(self, name: str) -> DataFrame:
        return getattr(self, name)()


MARTS = gold.MARTS
SILVER_TABLES = ["products", "customers", "exchange_rates", "orders", "order_items"]
