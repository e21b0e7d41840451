"""Incremental JDBC strides and the live join over two databases (embedded
in-memory Derby, no port)."""
import datetime as dt
import uuid
from decimal import Decimal as D

from pyspark.sql import functions as F

from strata.plans.bronze import extract
from strata.plans.sources_config import retail_sources
from strata.sources import live

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
PROPS = {"driver": DERBY}


def database():
    return f"jdbc:derby:memory:strata{uuid.uuid4().hex[:8]};create=true"


def orders(spark, ids, day):
    rows = [(i, i % 7, dt.datetime(2026, 1, day), dt.date(2026, 1, day), "PLACED" if i % 2 else "SHIPPED", D(i)) for i in ids]
    return spark.createDataFrame(rows, "order_id BIGINT, customer_id BIGINT, order_ts TIMESTAMP, order_date DATE, order_status STRING, order_total DECIMAL(12,2)")


def test_new_rows_spread_over_the_strides(spark, store):
    url = database()
    orders(spark, range(0, 4000), 1).write.jdbc(url, "orders", "overwrite", PROPS)
    spec = retail_sources({"orders_db": {"url": url, "driver": DERBY, "partitions": 4}})[0]
    extract(spark, store, spec, batch_id="a")
    orders(spark, range(4000, 4100), 2).write.jdbc(url, "orders", "append", PROPS)
    new = spec.rows(spark, lambda df: df.where(F.col("order_ts") > F.lit("2026-01-01 00:00:00").cast("timestamp")))
    sizes = [r["count"] for r in new.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100 and len(sizes) == 4 and max(sizes) <= 30
    assert extract(spark, store, spec, batch_id="b").rows == 100


def test_live_join_pushes_filters_into_both_databases(spark):
    shop, crm = database(), database()
    orders(spark, range(40), 3).write.option("createTableColumnTypes", "order_status VARCHAR(20)").jdbc(shop, "orders", "overwrite", PROPS)
    people = spark.createDataFrame([(i, f"land{i}", "VIP") for i in range(5)], "customer_id BIGINT, country STRING, customer_segment STRING")
    people.write.jdbc(crm, "customers", "overwrite", PROPS)
    lower = lambda df: df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
    read = lambda url, table: lower(spark.read.format("jdbc").options(url=url, dbtable=table, **PROPS).load())
    gold = spark.createDataFrame([(1, 9, 9.5)], "customer_id BIGINT, lifetime_order_count BIGINT, lifetime_revenue_usd DOUBLE")
    out = live.live_customer_orders(read(shop, "orders"), read(crm, "customers"), gold).where("customer_id <= 3")
    got = {r["customer_id"]: (r["open_order_count"], r["country"], r["lifetime_order_count"]) for r in out.collect()}
    assert got == {i: (len(range(i, 40, 7)), f"land{i}", 9 if i == 1 else None) for i in range(4)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "Scan JDBC" in x]
    assert len({x.split("JDBCRelation(")[1].split(")")[0] for x in scans}) == 2
    assert all("LessThanOrEqual(customer_id,3)" in x for x in scans)
    assert any("order_status" in x.split("PushedFilters")[1] for x in scans if "(orders)" in x)


def test_clustered_keys_spread_over_the_strides(spark, store):
    """Two far clusters, one of them dense: strides of equal width would put
    nearly all rows into one."""
    url = database()
    ids = [*range(0, 3000), *range(10_000_000, 10_001_000, 10), 2_000_000_000]
    orders(spark, ids, 1).write.jdbc(url, "orders", "overwrite", PROPS)
    spec = retail_sources({"orders_db": {"url": url, "driver": DERBY, "partitions": 8}})[0]
    df = spec.rows(spark, lambda df: df)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(ids) and max(sizes) <= 2 * len(ids) / 8
    assert extract(spark, store, spec, batch_id="a").rows == len(ids)


def test_repeated_and_null_split_values_are_read_once():
    from strata.plans.sources_config import stride_predicates

    assert stride_predicates("K", []) == ["1 = 1"]
    assert stride_predicates("K", [5]) == ["K <= 5 OR K IS NULL", "K > 5"]
    assert stride_predicates("K", [5, 9]) == ["K <= 5 OR K IS NULL", "K > 5 AND K <= 9", "K > 9"]


def test_live_join_hands_few_keys_to_the_other_database(spark):
    shop, crm = database(), database()
    orders(spark, range(40), 3).write.option("createTableColumnTypes", "order_status VARCHAR(20)").jdbc(shop, "orders", "overwrite", PROPS)
    people = spark.createDataFrame([(i, f"land{i}", "VIP") for i in range(2, 30)], "customer_id BIGINT, country STRING, customer_segment STRING")
    people.write.jdbc(crm, "customers", "overwrite", PROPS)
    lower = lambda df: df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
    read = lambda url, table: lower(spark.read.format("jdbc").options(url=url, dbtable=table, **PROPS).load())
    gold = spark.createDataFrame([], "customer_id BIGINT, lifetime_order_count BIGINT, lifetime_revenue_usd DOUBLE")
    found = {}
    for most in (1000, 5, 3, 0):
        out = live.live_customer_orders(read(shop, "orders"), read(crm, "customers").where("customer_id < 6"), gold, most)
        found[most] = sorted((r["customer_id"], r["open_order_count"], r["country"]) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        pushed = {x.split("JDBCRelation(")[1].split(")")[0]: x.split("PushedFilters")[1] for x in plan.splitlines() if "Scan JDBC" in x}
        # Four customers are few enough for a bound of five, not for one of three.
        assert all(("In(customer_id, [2,3,4,5])" in p) == (most >= 5) for p in (pushed["orders"], pushed["customers"]))
    assert found[1000] == found[5] == found[3] == found[0] == [(i, len(range(i, 40, 7)), f"land{i}") for i in range(2, 6)]
    none = live.live_customer_orders(read(shop, "orders").where("order_id < 0"), read(crm, "customers"), gold, 1000)
    assert none.collect() == []
