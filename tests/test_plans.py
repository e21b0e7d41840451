"""Physical-plan assertions: pushdown, pruning, broadcast decisions,
skew-safe operators."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import CUSTOMERS, FX, ORDERS, customer, frame, fx, order
from strata.operators.ranking import dense_rank_desc
from strata.plans import gold, silver
from strata.sources import watermark as wm


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_filter_and_pruning_reach_the_parquet_scan(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = wm.since(orders, "o_orderdate", "1998-01-01 00:00:00").select("o_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate,1998-01-01T00:00)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_lookups_are_left_to_spark(spark):
    customers = silver.silver_customers(frame(spark, CUSTOMERS, [customer(1)]), dt.date(2026, 1, 31)).good
    rates = silver.silver_exchange_rates(frame(spark, FX, [fx("EUR", "0.8")])).good
    bronze = frame(spark, ORDERS, [order(1)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = silver.silver_orders(bronze, customers, rates)
        logical = orders.flagged._jdf.queryExecution().analyzed().toString()
        assert "broadcast" not in logical.lower() and "SortMergeJoin" in plan(orders.flagged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_category_totals_are_an_aggregate_not_a_window(spark):
    products = spark.createDataFrame(
        [(1, "a", "A", "s", "b", True, Decimal(1), Decimal(2))],
        "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, brand STRING, "
        "is_active BOOLEAN, unit_cost DECIMAL(10,2), list_price DECIMAL(10,2)",
    )
    items = spark.createDataFrame([(1, 1, 1, 1, 1.0)], "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, line_total_usd DOUBLE")
    p = plan(gold.product_performance(products, gold.sales_by_product(items)))
    # totals come from a grouped aggregate joined back, never from a
    # window over the whole category
    assert "sum(_rev_cents) windowspecdefinition" not in p
    assert "HashAggregate(keys=[category" in p


def test_rank_has_no_window_over_a_whole_group(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    out = dense_rank_desc(df, "g", "v", "r")
    p = plan(out)
    # windows are keyed by (group, bucket) or run on the (group, bucket) counts
    assert "row_number() windowspecdefinition(g#" in p and "_rank_bucket" in p
    assert "[_off_g#" in p and out.count() == 100
    assert not any(c in p for c in ("RDDScan", "Scan ExistingRDD[g"))  # lazy: nothing ran while it was planned


def test_daily_sales_aggregates_items_before_the_join(spark):
    orders = spark.createDataFrame([], "order_id BIGINT, order_date DATE, sales_channel STRING, order_status STRING, order_total_usd DOUBLE, customer_id BIGINT")
    items = spark.createDataFrame([], "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, line_total_usd DOUBLE")
    logical = gold.daily_sales(orders, items)._jdf.queryExecution().optimizedPlan().toString()
    join_at = logical.index("Join LeftOuter")
    assert "Aggregate [order_id" in logical[join_at:]


def test_silver_reads_by_date_prune_month_partitions(spark, store):
    from strata.plans.pipeline import read_silver_between, write_silver

    rows = [order(i, day=dt.date(2026, m, 5)) for i, m in enumerate([1, 2, 3, 4], start=1)]
    customers = silver.silver_customers(frame(spark, CUSTOMERS, [customer(1)]), dt.date(2026, 12, 31)).good
    rates = silver.silver_exchange_rates(frame(spark, FX, [fx("EUR", "0.8")])).good
    result = silver.silver_orders(frame(spark, ORDERS, rows), customers, rates)
    assert write_silver(store, "orders", result, dt.datetime(2026, 12, 31)) == (4, 0)
    df = read_silver_between(store, "orders", dt.date(2026, 2, 1), dt.date(2026, 3, 31))
    assert sorted(r["order_id"] for r in df.collect()) == [2, 3]
    p = plan(df)
    assert "PartitionFilters: [isnotnull(_month" in p and "2026-02" in p


# -- skew: one key holds about a third of the rows, nothing is broadcast ------

N = 3000
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def lake(spark, tmp_path):
    """Made-up tables in the driver's layout: order 3, customer 3 and part 3 are hot."""
    from strata.plans.views import RetailLake

    hot = "CASE WHEN id % 3 = 0 THEN 3 ELSE id END"
    day = "TIMESTAMP_NTZ '1996-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 300 AS INT))"
    made = {
        "orders": (N, f"id + 1 AS o_orderkey, {hot} AS o_custkey, 'F' AS o_orderstatus, CAST(id AS DOUBLE) AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        "lineitem": (N, f"{hot} AS l_orderkey, {hot} AS l_partkey, CAST(id AS INT) AS l_linenumber, 1.0D AS l_quantity, 10.0D AS l_extendedprice, 0.0D AS l_discount, {day} AS l_shipdate"),
        "customer": (N, "id AS c_custkey, concat('C#', id) AS c_name, 1 AS c_nationkey, 1.0D AS c_acctbal, 'AUTOMOBILE' AS c_mktsegment"),
        "part": (N, "id AS p_partkey, concat('p ', id) AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size, 9.0D AS p_retailprice"),
        "nation": (2, "CAST(id AS INT) AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey"),
        "region": (2, "CAST(id AS INT) AS r_regionkey, 'r' AS r_name"),
    }
    for name, (n, cols) in made.items():
        spark.range(n).selectExpr(*_columns(cols)).write.parquet(f"{tmp_path}/{name}.parquet")
    return RetailLake(spark, str(tmp_path))


def _columns(text):
    """Splits at commas outside parentheses."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(text[at:i])
            at = i + 1
    return [*out, text[at:]]


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def split_joins(p):
    return [x for x in p.splitlines() if "SortMergeJoin(skew=true)" in x or "isSkewJoin=true" in x]


def test_hot_customer_is_split_in_the_orders_lookup(lake, skew):
    rows, p = executed(lake.orders.good)
    assert len(rows) > 0.9 * N and any("customer_id" in x for x in split_joins(p))


def test_hot_product_and_order_are_split_in_the_items_lookups(lake, skew):
    rows, p = executed(lake.order_items.good)
    assert len(rows) > N / 2
    assert any("product_id" in x for x in split_joins(p)) and any("order_id" in x for x in split_joins(p))


def test_daily_sales_sums_a_hot_order_before_it_joins(lake, skew):
    rows, p = executed(lake.daily_sales())
    assert sum(r["order_count"] for r in rows) > 0.9 * N
    assert "partial_sum(quantity" in p and "_sold_in" in p
    assert any("customer_id" in x for x in split_joins(p)) and any("product_id" in x for x in split_joins(p))


def test_customer_360_sums_a_hot_customer_before_it_joins(lake, skew):
    rows, p = executed(lake.customer_360())
    assert max(r["lifetime_order_count"] for r in rows) >= N / 3
    assert "_probe_key" not in p  # no look-up of the hot key
    assert "partial_count(order_id" in p


def test_inventory_sums_a_hot_product_before_it_joins(lake, skew):
    rows, p = executed(lake.inventory_summary())
    assert max(r["lifetime_units_sold"] for r in rows) >= N / 3 - 1
    assert "partial_sum(quantity" in p
    assert any("order_id" in x for x in split_joins(p))


def test_null_keyed_items_are_found_by_a_pushed_filter(lake):
    p = lake.order_items.quarantine._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(l_orderkey),IsNull(l_linenumber))]" in p
