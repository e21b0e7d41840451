"""Bronze-shaped views over the driver's TPC-H-like Parquet tables.

The five retail source tables (orders, order_items, customers, products,
exchange_rates) are derived from ``orders``, ``lineitem``, ``customer``
(+ ``nation``, ``region``) and ``part``.  Each view has the source schema
plus ``_bronze_ingested_at`` / ``_bronze_source``, so silver and gold
jobs run on them unchanged.  Everything is a projection of a scan, so
Catalyst prunes columns and pushes filters into the Parquet readers.

--- Fixed values of this mapping (shared with the DuckDB oracle SQL) ---
order status:   F -> DELIVERED; O -> PLACED; other -> by o_orderkey % 3:
                0 RETURNED, 1 CANCELLED, 2 SHIPPED
sales channel:  priority 1-URGENT, 2-HIGH, 3-MEDIUM -> ONLINE;
                5-LOW -> STORE; anything else -> UNKNOWN
currency:       o_orderkey % 20: 0-10 USD, 11-14 EUR, 15-16 GBP, 17-19 EGP
shipping cost:  (o_orderkey % 1500) / 100
order item id:  l_orderkey * 10 + l_linenumber (not unique on purpose)
email:          lower(c_name with '#' -> '.') + '@mail.test',
                or + '@invalid' when c_custkey % 97 = 0
signup date:    1990-01-01 + (c_custkey % 1800) days
segment:        AUTOMOBILE -> VIP, MACHINERY -> WHOLESALE, other -> RETAIL
unit cost:      list_price * (60 + p_size) / 100, half-up to cents
fx rates:       every order date x (EUR 0.920, GBP 0.790, EGP 48.500),
                rate = base * (991 + day_of_month % 19) / 1000;
                EGP has no rate on days where day_of_month % 29 = 0
ingestion time: orders o_orderdate, items l_shipdate, other tables
                2001-12-31 00:00:00
--- end of fixed values ---
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit
from strata.operators.audit import INGESTED_AT, SOURCE

SNAPSHOT_TS = dt.datetime(2001, 12, 31, 0, 0, 0)
SIGNUP_EPOCH = dt.date(1990, 1, 1)
FX_BASES_MILLI = [("EUR", 920), ("GBP", 790), ("EGP", 48500)]

# Deterministic D1 tie-breakers for the views (H5): with them every
# dedupe winner is fixed, also when a task is recomputed.
ITEM_TIE_BREAKERS = ["product_id", "line_total", "quantity", "discount_pct"]


def to_decimal(col: str | F.Column, precision: int, scale: int) -> F.Column:
    """A double as ``decimal(precision, scale)``, rounded half-up (toward
    +inf) on its binary value.  Integer arithmetic plus one multiply by
    ``10^-scale`` keeps the value in Spark's compact decimal form; a
    plain ``cast`` parses every double through its decimal string."""
    c = F.col(col) if isinstance(col, str) else col
    units = F.floor(c * (10 ** scale) + 0.5).cast(f"decimal({precision},0)")
    step = F.lit(10 ** -scale).cast(f"decimal({scale},{scale})")
    return (units * step).cast(f"decimal({precision},{scale})")


# Declared read schemas: the columns the views use, with the driver's
# Parquet types (timestamps carry no zone, i.e. TIMESTAMP_NTZ).  Declaring
# them skips footer-based schema inference and prunes the rest.
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _snapshot_ts() -> F.Column:
    return ts_lit(SNAPSHOT_TS, ntz=True)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "DELIVERED")
        .when(F.col("o_orderstatus") == "O", "PLACED")
        .when(key % 3 == 0, "RETURNED")
        .when(key % 3 == 1, "CANCELLED")
        .otherwise("SHIPPED")
    )
    channel = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "ONLINE")
        .when(F.col("o_orderpriority") == "5-LOW", "STORE")
        .otherwise("UNKNOWN")
    )
    m = key % 20
    currency = (
        F.when(m < 11, "USD").when(m < 15, "EUR").when(m < 17, "GBP").otherwise("EGP")
    )
    return o.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").alias("order_ts"),
        status.alias("order_status"),
        channel.alias("sales_channel"),
        currency.alias("currency_code"),
        ((key % 1500).cast("decimal(10,0)") * F.lit(0.01).cast("decimal(2,2)"))
        .cast("decimal(10,2)")
        .alias("shipping_cost"),
        to_decimal("o_totalprice", 12, 2).alias("order_total"),
        F.col("o_orderdate").alias(INGESTED_AT),
        F.lit("tpch-orders").alias(SOURCE),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_items(table(spark, sf_dir, "lineitem"))


def order_items_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items whose id is NULL, told by the columns it is made of: the
    filter reaches the scan, where row groups without NULLs are skipped."""
    li = table(spark, sf_dir, "lineitem")
    return _order_items(li.where(F.col("l_orderkey").isNull() | F.col("l_linenumber").isNull()))


def _order_items(li: DataFrame) -> DataFrame:
    qty = F.col("l_quantity").cast("int")
    line_total = to_decimal("l_extendedprice", 12, 2)
    # unit price = line_total / quantity, half-up to cents, in integer
    # arithmetic (decimal division would widen to decimal(23,13), which
    # Spark evaluates with BigDecimal on every row).
    line_cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint")
    unit_cents = F.call_function("div", line_cents * 2 + qty, qty * 2)
    unit_price = F.when(
        qty > 0, (unit_cents.cast("decimal(12,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)")
    )
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("quantity"),
        unit_price.alias("unit_price"),
        to_decimal("l_discount", 4, 3).alias("discount_pct"),
        line_total.alias("line_total"),
        F.col("l_shipdate").alias(INGESTED_AT),
        F.lit("tpch-lineitem").alias(SOURCE),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(
        r, F.col("n_regionkey") == r.r_regionkey, "left"
    )
    key = F.col("c_custkey")
    email = F.concat(
        F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
        F.when(key % 97 == 0, F.lit("@invalid")).otherwise(F.lit("@mail.test")),
    )
    segment = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "VIP")
        .when(F.col("c_mktsegment") == "MACHINERY", "WHOLESALE")
        .otherwise("RETAIL")
    )
    return joined.select(
        key.alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        email.alias("email"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("city"),
        F.date_add(F.lit(SIGNUP_EPOCH), (key % 1800).cast("int")).alias("signup_date"),
        segment.alias("customer_segment"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        _snapshot_ts().alias(INGESTED_AT),
        F.lit("tpch-customer").alias(SOURCE),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    list_price = to_decimal("p_retailprice", 10, 2)
    list_cents = F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint")
    cost_cents = F.call_function("div", list_cents * (F.col("p_size") + 60) * 2 + 100, F.lit(200))
    unit_cost = (cost_cents.cast("decimal(10,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        unit_cost.alias("unit_cost"),
        list_price.alias("list_price"),
        F.lit(True).alias("is_active"),
        _snapshot_ts().alias(INGESTED_AT),
        F.lit("tpch-part").alias(SOURCE),
    )


def exchange_rates(
    spark: SparkSession, sf_dir: str, with_gaps: bool = True, bump_pct: int = 0
) -> DataFrame:
    """One rate per order date and quoted currency, derived from the
    orders table (a distinct over one date column, then a fixed
    three-way ``explode`` -- no join).

    ``with_gaps=False`` keeps the EGP days that normally have no rate;
    ``bump_pct`` raises every rate by that many percent (an older, stale
    copy of the file for the dedupe test)."""
    dates = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").cast("date").alias("rate_date"))
        .distinct()
    )
    quotes = F.array(
        *[
            F.struct(F.lit(cur).alias("quote_currency"), F.lit(milli).alias("base_milli"))
            for cur, milli in FX_BASES_MILLI
        ]
    )
    day = F.dayofmonth("rate_date")
    scaled = F.col("q.base_milli").cast("bigint") * (F.lit(991) + day % 19) * (100 + bump_pct) + 50
    micro = F.call_function("div", scaled, F.lit(100))  # half-up to millionths
    rates = dates.select("rate_date", F.explode(quotes).alias("q")).select(
        "rate_date",
        F.lit("USD").alias("base_currency"),
        F.col("q.quote_currency").alias("quote_currency"),
        (micro.cast("decimal(12,0)") * F.lit(0.000001).cast("decimal(6,6)"))
        .cast("decimal(12,6)")
        .alias("rate"),
        _snapshot_ts().alias(INGESTED_AT),
        F.lit("tpch-fx").alias(SOURCE),
    )
    if not with_gaps:
        return rates
    return rates.where(~((F.col("quote_currency") == "EGP") & (day % 29 == 0)))


def source_frame(view: DataFrame) -> DataFrame:
    """A view as its *source* system would return it (no audit columns)."""
    return view.drop(INGESTED_AT, SOURCE)


VIEWS = {
    "orders": orders,
    "order_items": order_items,
    "customers": customers,
    "products": products,
    "exchange_rates": exchange_rates,
}


def bronze_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in VIEWS.items()}
