import datetime as dt

from pyspark.sql import functions as F

from strata.plans import gold

D1, D2 = dt.date(2026, 1, 5), dt.date(2026, 1, 6)
ORDERS = "order_id BIGINT, customer_id BIGINT, order_date DATE, order_status STRING, sales_channel STRING, order_total_usd DOUBLE"
ITEMS = "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, line_total_usd DOUBLE"
CUSTOMERS = "customer_id BIGINT, first_name STRING, last_name STRING, country STRING, city STRING, customer_segment STRING, is_active BOOLEAN, signup_date DATE"
PRODUCTS = "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, brand STRING, is_active BOOLEAN, unit_cost DECIMAL(10,2), list_price DECIMAL(10,2)"


def test_daily_sales_counts_and_items(spark):
    orders = spark.createDataFrame(
        [(1, 1, D1, "RETURNED", "ONLINE", 10.0), (2, 1, D1, "CANCELLED", "ONLINE", 20.0),
         (3, 1, D1, "PLACED", "STORE", 5.0), (4, 2, D2, "PLACED", "STORE", 7.5)], ORDERS)
    items = spark.createDataFrame([(10, 1, 1, 2, 10.0), (11, 1, 2, 3, 0.0), (12, 2, 1, 1, 20.0)], ITEMS)
    got = {(r["order_date"], r["sales_channel"]): r.asDict() for r in gold.daily_sales(orders, items).collect()}
    online = got[(D1, "ONLINE")]
    assert (online["order_count"], online["total_revenue_usd"], online["avg_order_value_usd"]) == (2, 30.0, 15.0)
    assert (online["total_items_sold"], online["returned_order_count"], online["cancelled_order_count"]) == (6, 1, 1)
    # Orders without items: total_items_sold is NULL for that group alone.
    assert got[(D1, "STORE")]["total_items_sold"] is None
    assert got[(D2, "STORE")]["total_items_sold"] is None


def test_half_cent_average_rounds_up_in_any_order(spark):
    rows = [(i, 1, D1, "PLACED", "ONLINE", v) for i, v in enumerate([0.01, 0.02])]
    for parts in (1, 2):
        orders = spark.createDataFrame(rows, ORDERS).repartition(parts)
        items = spark.createDataFrame([], ITEMS)
        r = gold.daily_sales(orders, items).first()
        assert r["avg_order_value_usd"] == 0.02 and r["total_revenue_usd"] == 0.03


def test_customer_360_customer_without_orders(spark):
    customers = spark.createDataFrame(
        [(1, "a", "b", "X", "Y", "VIP", True, D1), (2, "c", "d", "X", "Y", "RETAIL", False, D1)], CUSTOMERS)
    orders = spark.createDataFrame(
        [(1, 1, D1, "CANCELLED", "ONLINE", 10.0), (2, 1, D2, "PLACED", "ONLINE", 20.01)], ORDERS)
    got = {r["customer_id"]: r.asDict() for r in gold.customer_360(customers, orders, dt.date(2026, 1, 31)).collect()}
    one = got[1]
    assert (one["lifetime_order_count"], one["lifetime_revenue_usd"], one["avg_order_value_usd"]) == (2, 30.01, 15.01)
    assert (one["first_order_date"], one["last_order_date"], one["days_since_last_order"]) == (D1, D2, 25)
    two = got[2]
    assert (two["lifetime_order_count"], two["lifetime_revenue_usd"], two["avg_order_value_usd"]) == (0, 0.0, None)
    assert two["days_since_last_order"] is None


def test_monthly_revenue_lag_uses_previous_present_month(spark):
    orders = spark.createDataFrame(
        [(1, 1, dt.date(2026, 1, 3), "PLACED", "ONLINE", 100.0),
         (2, 1, dt.date(2026, 3, 3), "PLACED", "ONLINE", 150.0),
         (3, 1, dt.date(2026, 4, 3), "PLACED", "ONLINE", 0.0),
         (4, 1, dt.date(2026, 5, 3), "PLACED", "ONLINE", 10.0)], ORDERS)
    got = {r["year_month"]: r.asDict() for r in gold.monthly_revenue(orders).collect()}
    assert got["2026-01"]["prev_month_revenue_usd"] is None and got["2026-01"]["mom_revenue_growth_pct"] is None
    assert got["2026-03"]["prev_month_revenue_usd"] == 100.0 and got["2026-03"]["mom_revenue_growth_pct"] == 50.0
    assert got["2026-04"]["mom_revenue_growth_pct"] == -100.0
    # previous revenue 0 -> growth NULL
    assert got["2026-05"]["mom_revenue_growth_pct"] is None


def _products(spark, rows):
    from decimal import Decimal as D
    return spark.createDataFrame(
        [(pid, f"p{pid}", cat, "s", "b", True, D(cost), D(price)) for pid, cat, cost, price in rows], PRODUCTS)


def test_inventory_unsold_product_and_zero_price(spark):
    products = _products(spark, [(1, "A", "5.00", "10.00"), (2, "A", "0.00", "0.00"), (3, "A", "1.00", "3.00")])
    items = spark.createDataFrame([(1, 1, 1, 4, 40.0)], ITEMS)
    got = {r["product_id"]: r.asDict() for r in gold.inventory_summary(products, gold.sales_by_product(items)).collect()}
    assert (got[1]["lifetime_units_sold"], got[1]["lifetime_revenue_usd"], float(got[1]["margin_pct"])) == (4, 40.0, 50.0)
    assert (got[2]["lifetime_units_sold"], got[2]["lifetime_revenue_usd"], got[2]["margin_pct"]) == (0, 0.0, None)
    assert float(got[3]["margin_pct"]) == 66.67


def test_product_performance_ranks_and_shares(spark):
    products = _products(spark, [(1, "A", "1", "2"), (2, "A", "1", "2"), (3, "A", "1", "2"),
                                 (4, "B", "1", "2"), (5, None, "1", "2")])
    items = spark.createDataFrame([(1, 1, 1, 1, 30.0), (2, 1, 2, 1, 30.0), (3, 1, 3, 1, 15.0), (4, 1, 5, 1, 9.0)], ITEMS)
    got = {r["product_id"]: r.asDict() for r in gold.product_performance(products, gold.sales_by_product(items)).collect()}
    assert 5 not in got  # NULL category vanishes (inner-join semantics)
    assert [got[i]["rank_in_category"] for i in (1, 2, 3)] == [1, 1, 2]  # dense, ties share
    assert [got[i]["pct_of_category_revenue"] for i in (1, 2, 3)] == [40.0, 40.0, 20.0]
    # category total 0 -> 0.0 %
    assert (got[4]["revenue_usd"], got[4]["pct_of_category_revenue"], got[4]["rank_in_category"]) == (0.0, 0.0, 1)


def test_dense_rank_equals_the_window_form_with_a_hot_group(spark):
    from pyspark.sql import Window

    from strata.operators.ranking import dense_rank_desc, value_bucket

    # group 'hot' holds most rows, with repeated, negative and NULL values
    df = spark.range(3000).selectExpr(
        "id",
        "CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 < 9 THEN 'warm' ELSE NULL END AS g",
        "CASE WHEN id % 97 = 0 THEN NULL ELSE (id * 7919) % 500 - 60 END AS v",
    )
    split = dense_rank_desc(df, "g", "v", "r")
    plain = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert split.count() == 3000
    assert split.exceptAll(plain.select(*split.columns)).count() == 0
    # buckets never change the order of values
    wide = spark.range(-500, 500).select((F.col("id") * F.abs(F.col("id")) * 7919).alias("v"))
    rows = wide.select("v", value_bucket(F.col("v")).alias("b")).orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(rows, rows[1:])) and rows[0]["b"] < rows[-1]["b"]


def test_growth_is_exact_half_away_from_zero(spark):
    from fractions import Fraction
    from random import Random

    from strata.functions.money import growth_pct

    rng = Random(5)
    pairs = [(0, 5), (None, 5), (7, 7), (8, 5), (800, 801), (-4, 3)] + [(rng.randint(1, 10**11), rng.randint(0, 10**11)) for _ in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i INT, a BIGINT, b BIGINT")
    got = {r["i"]: r["g"] for r in df.select("i", growth_pct("a", "b").alias("g")).collect()}
    for i, (a, b) in enumerate(pairs):
        if not a:
            assert got[i] is None
            continue
        exact = Fraction(b - a, a) * 10_000
        size = (2 * abs(exact.numerator) + exact.denominator) // (2 * exact.denominator)
        assert got[i] == (size if exact >= 0 else -size) / 100
