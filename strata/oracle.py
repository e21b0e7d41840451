"""DuckDB re-statement of every registered query, for the correctness gate.

Independent SQL over the driver's raw tables (views ``orders``,
``lineitem``, ``customer``, ``nation``, ``region``, ``part``): the same
mapping and rules as ``strata.sources.testdata`` and the silver / gold
plans, written as CTEs.  Money is aggregated in whole cents and
averages/percentages are rounded half-up with integer division, exactly
like the Spark side, so results compare bit for bit.
"""
from __future__ import annotations

from strata.sources.broken import variants

EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

BRONZE = r"""
b_orders AS (
  SELECT o_orderkey AS order_id,
         o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         o_orderdate AS order_ts,
         CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED'
              WHEN o_orderstatus = 'O' THEN 'PLACED'
              WHEN o_orderkey % 3 = 0 THEN 'RETURNED'
              WHEN o_orderkey % 3 = 1 THEN 'CANCELLED'
              ELSE 'SHIPPED' END AS order_status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'ONLINE'
              WHEN o_orderpriority = '5-LOW' THEN 'STORE'
              ELSE 'UNKNOWN' END AS sales_channel,
         CASE WHEN o_orderkey % 20 < 11 THEN 'USD'
              WHEN o_orderkey % 20 < 15 THEN 'EUR'
              WHEN o_orderkey % 20 < 17 THEN 'GBP'
              ELSE 'EGP' END AS currency_code,
         CAST((o_orderkey % 1500) / 100 AS DECIMAL(10,2)) AS shipping_cost,
         CAST(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) / 100 AS DECIMAL(12,2)) AS order_total,
         o_orderdate AS _bronze_ingested_at
  FROM orders
),
b_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN CAST(l_quantity AS INTEGER) > 0 THEN
           CAST(((CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * 2
                  + CAST(l_quantity AS INTEGER)) // (2 * CAST(l_quantity AS INTEGER))) / 100
                AS DECIMAL(10,2)) END AS unit_price,
         CAST(CAST(floor(l_discount * 1000 + 0.5) AS BIGINT) / 1000 AS DECIMAL(4,3)) AS discount_pct,
         CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) / 100 AS DECIMAL(12,2)) AS line_total,
         l_shipdate AS _bronze_ingested_at
  FROM lineitem
),
b_customers AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         lower(replace(c_name, '#', '.'))
           || CASE WHEN c_custkey % 97 = 0 THEN '@invalid' ELSE '@mail.test' END AS email,
         n_name AS country,
         r_name AS city,
         CAST(DATE '1990-01-01' + CAST(c_custkey % 1800 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'VIP'
              WHEN c_mktsegment = 'MACHINERY' THEN 'WHOLESALE'
              ELSE 'RETAIL' END AS customer_segment,
         c_acctbal >= 0 AS is_active,
         TIMESTAMP '2001-12-31 00:00:00' AS _bronze_ingested_at
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
b_products AS (
  SELECT p_partkey AS product_id,
         p_name AS product_name,
         p_type AS category,
         split_part(p_name, ' ', 1) AS subcategory,
         p_brand AS brand,
         CAST(((CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)
                * (p_size + 60) * 2 + 100) // 200) / 100 AS DECIMAL(10,2)) AS unit_cost,
         CAST(CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) / 100 AS DECIMAL(10,2)) AS list_price,
         TRUE AS is_active,
         TIMESTAMP '2001-12-31 00:00:00' AS _bronze_ingested_at
  FROM part
),
b_fx_all AS (
  SELECT rate_date,
         'USD' AS base_currency,
         quote_currency,
         CAST(((base_milli * (991 + day(rate_date) % 19) * 100 + 50) // 100) / 1000000
              AS DECIMAL(12,6)) AS rate,
         CAST(((base_milli * (991 + day(rate_date) % 19) * 101 + 50) // 100) / 1000000
              AS DECIMAL(12,6)) AS stale_rate,
         TIMESTAMP '2001-12-31 00:00:00' AS _bronze_ingested_at
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders) d
  CROSS JOIN (VALUES ('EUR', 920), ('GBP', 790), ('EGP', 48500)) q(quote_currency, base_milli)
),
b_fx AS (
  SELECT * EXCLUDE (stale_rate) FROM b_fx_all
  WHERE NOT (quote_currency = 'EGP' AND day(rate_date) % 29 = 0)
)"""


def _latest(src: str, keys: str, order: str, null_key: str | None) -> str:
    """D1 in SQL; rows with a NULL ``null_key`` skip it (H4)."""
    where = f"WHERE {null_key} IS NOT NULL" if null_key else ""
    body = (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS _rn FROM {src} {where}) WHERE _rn = 1"
    )
    if null_key:
        body += f" UNION ALL SELECT * FROM {src} WHERE {null_key} IS NULL"
    return body


def _flags(*checks: tuple[str, str]) -> str:
    parts = [f"CASE WHEN {cond} THEN NULL ELSE '{name}' END" for name, cond in checks]
    return "concat_ws(',', " + ", ".join(parts) + ") AS _dq_failed_checks"


SILVER = f"""
c_cand AS ({_latest('b_customers', 'customer_id', '_bronze_ingested_at DESC NULLS LAST', 'customer_id')}),
c_flag AS (
  SELECT *, {_flags(
      ('customer_id_not_null', 'customer_id IS NOT NULL'),
      ('email_well_formed', f"regexp_matches(email, '{EMAIL_RE}')"),
      ('signup_date_not_null', 'signup_date IS NOT NULL'),
      ('signup_date_not_future', "signup_date <= DATE '2001-12-31'"),
      ('customer_segment_valid', "customer_segment IN ('VIP', 'RETAIL', 'WHOLESALE')"),
  )} FROM c_cand
),
c_good AS (SELECT * EXCLUDE (_dq_failed_checks) FROM c_flag WHERE _dq_failed_checks = ''),
p_cand AS ({_latest('b_products', 'product_id', '_bronze_ingested_at DESC NULLS LAST', 'product_id')}),
p_flag AS (
  SELECT *, {_flags(
      ('product_id_not_null', 'product_id IS NOT NULL'),
      ('product_name_not_null', 'product_name IS NOT NULL'),
      ('unit_cost_non_negative', 'unit_cost >= 0'),
      ('list_price_non_negative', 'list_price >= 0'),
      ('list_price_gte_unit_cost', 'list_price >= unit_cost'),
  )} FROM p_cand
),
p_good AS (SELECT * EXCLUDE (_dq_failed_checks) FROM p_flag WHERE _dq_failed_checks = ''),
fx_cand AS ({_latest('b_fx', 'rate_date, base_currency, quote_currency', '_bronze_ingested_at DESC NULLS LAST', 'rate_date')}),
fx_flag AS (
  SELECT *, {_flags(
      ('rate_date_not_null', 'rate_date IS NOT NULL'),
      ('rate_positive', 'rate > 0'),
      ('base_currency_is_usd', "base_currency = 'USD'"),
  )} FROM fx_cand
),
fx_good AS (SELECT * EXCLUDE (_dq_failed_checks) FROM fx_flag WHERE _dq_failed_checks = ''),
o_cand AS ({_latest('b_orders', 'order_id', '_bronze_ingested_at DESC NULLS LAST', 'order_id')}),
o_join AS (
  SELECT o.*,
         EXISTS (SELECT 1 FROM c_good c WHERE c.customer_id = o.customer_id) AS _known_customer,
         f.rate
  FROM o_cand o
  LEFT JOIN fx_good f ON o.order_date = f.rate_date AND o.currency_code = f.quote_currency
),
o_conv AS (
  SELECT *, CASE WHEN currency_code = 'USD' THEN CAST(1.0 AS DOUBLE)
                 ELSE CAST(rate AS DOUBLE) END AS fx_rate_to_usd
  FROM o_join
),
o_usd AS (
  SELECT *, round(CAST(order_total AS DOUBLE) / fx_rate_to_usd, 2) AS order_total_usd,
            round(CAST(shipping_cost AS DOUBLE) / fx_rate_to_usd, 2) AS shipping_cost_usd
  FROM o_conv
),
o_flag AS (
  SELECT * EXCLUDE (_known_customer, rate), {_flags(
      ('order_id_not_null', 'order_id IS NOT NULL'),
      ('customer_id_exists', '_known_customer'),
      ('order_status_valid', "order_status IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')"),
      ('sales_channel_valid', "sales_channel IN ('ONLINE', 'STORE')"),
      ('order_total_non_negative', 'order_total >= 0'),
      ('fx_conversion_resolved', 'order_total_usd IS NOT NULL'),
  )} FROM o_usd
),
o_good AS (SELECT * EXCLUDE (_dq_failed_checks) FROM o_flag WHERE _dq_failed_checks = ''),
i_cand AS ({_latest('b_items', 'order_item_id',
    '_bronze_ingested_at DESC NULLS LAST, product_id DESC NULLS LAST, line_total DESC NULLS LAST, '
    'quantity DESC NULLS LAST, discount_pct DESC NULLS LAST', 'order_item_id')}),
i_join AS (
  SELECT i.*, o.order_date, o.fx_rate_to_usd, o.order_id IS NOT NULL AS _known_order,
         EXISTS (SELECT 1 FROM p_good p WHERE p.product_id = i.product_id) AS _known_product
  FROM i_cand i
  LEFT JOIN (SELECT order_id, order_date, fx_rate_to_usd FROM o_good) o ON i.order_id = o.order_id
),
i_usd AS (
  SELECT *, round(CAST(line_total AS DOUBLE) / fx_rate_to_usd, 2) AS line_total_usd FROM i_join
),
i_flag AS (
  SELECT * EXCLUDE (_known_order, _known_product, fx_rate_to_usd), {_flags(
      ('order_item_id_not_null', 'order_item_id IS NOT NULL'),
      ('order_id_exists', '_known_order'),
      ('product_id_exists', '_known_product'),
      ('quantity_positive', 'quantity > 0'),
      ('unit_price_non_negative', 'unit_price >= 0'),
  )} FROM i_usd
),
i_good AS (SELECT * EXCLUDE (_dq_failed_checks) FROM i_flag WHERE _dq_failed_checks = '')"""


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def avg_money(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN ((CAST({s} AS HUGEINT) * 2 + {n}) // (2 * {n})) / 100 END"


GOLD = f"""
g_items_per_order AS (
  SELECT order_id, sum(quantity) AS items_in_order FROM i_good GROUP BY order_id
),
g_daily_sales AS (
  SELECT o.order_date, o.sales_channel,
         count(o.order_id) AS order_count,
         CAST(sum({cents('o.order_total_usd')}) AS BIGINT) / 100 AS total_revenue_usd,
         {avg_money(f"sum({cents('o.order_total_usd')})", 'count(o.order_total_usd)')} AS avg_order_value_usd,
         CAST(sum(ipo.items_in_order) AS BIGINT) AS total_items_sold,
         count_if(o.order_status = 'RETURNED') AS returned_order_count,
         count_if(o.order_status = 'CANCELLED') AS cancelled_order_count
  FROM o_good o LEFT JOIN g_items_per_order ipo ON o.order_id = ipo.order_id
  GROUP BY o.order_date, o.sales_channel
),
g_order_agg AS (
  SELECT customer_id,
         count(order_id) AS lifetime_order_count,
         sum({cents('order_total_usd')}) AS sum_cents,
         count(order_total_usd) AS n,
         min(order_date) AS first_order_date,
         max(order_date) AS last_order_date
  FROM o_good GROUP BY customer_id
),
g_customer_360 AS (
  SELECT c.customer_id, c.first_name, c.last_name, c.country, c.city, c.customer_segment,
         c.is_active, c.signup_date,
         COALESCE(a.lifetime_order_count, 0) AS lifetime_order_count,
         CAST(COALESCE(a.sum_cents, 0) AS BIGINT) / 100 AS lifetime_revenue_usd,
         {avg_money('a.sum_cents', 'a.n')} AS avg_order_value_usd,
         a.first_order_date, a.last_order_date,
         CAST(datediff('day', a.last_order_date, DATE '2001-12-31') AS INTEGER) AS days_since_last_order
  FROM c_good c LEFT JOIN g_order_agg a ON c.customer_id = a.customer_id
),
g_monthly_base AS (
  SELECT strftime(order_date, '%Y-%m') AS year_month,
         CAST(sum({cents('order_total_usd')}) AS BIGINT) AS now_cents,
         count(order_id) AS order_count,
         {avg_money(f"sum({cents('order_total_usd')})", 'count(order_total_usd)')} AS avg_order_value_usd
  FROM o_good GROUP BY 1
),
g_monthly_revenue AS (
  SELECT year_month, now_cents / 100 AS total_revenue_usd, order_count, avg_order_value_usd,
         before_cents / 100 AS prev_month_revenue_usd,
         CASE WHEN before_cents <> 0 THEN
           CASE WHEN now_cents >= before_cents THEN 1 ELSE -1 END
           * ((CAST(abs(now_cents - before_cents) AS HUGEINT) * 20000 + before_cents) // (2 * before_cents)) / 100
         END AS mom_revenue_growth_pct
  FROM (SELECT *, lag(now_cents) OVER (ORDER BY year_month) AS before_cents FROM g_monthly_base)
),
g_sales AS (
  SELECT product_id, sum(quantity) AS units, sum({cents('line_total_usd')}) AS rev_cents
  FROM i_good GROUP BY product_id
),
g_inventory_summary AS (
  SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.is_active,
         p.unit_cost, p.list_price,
         CASE WHEN p.list_price > 0 THEN CAST(
           ((CAST((p.list_price - p.unit_cost) * 100 AS HUGEINT) * 20000 + CAST(p.list_price * 100 AS BIGINT))
             // (2 * CAST(p.list_price * 100 AS BIGINT))) / 100 AS DECIMAL(12,2)) END AS margin_pct,
         CAST(COALESCE(s.units, 0) AS BIGINT) AS lifetime_units_sold,
         CAST(COALESCE(s.rev_cents, 0) AS BIGINT) / 100 AS lifetime_revenue_usd
  FROM p_good p LEFT JOIN g_sales s ON p.product_id = s.product_id
),
g_pp_base AS (
  SELECT p.product_id, p.product_name, p.category,
         CAST(COALESCE(s.units, 0) AS BIGINT) AS units_sold,
         CAST(COALESCE(s.rev_cents, 0) AS BIGINT) AS rev_cents
  FROM p_good p LEFT JOIN g_sales s ON p.product_id = s.product_id
  WHERE p.category IS NOT NULL
),
g_pp_tot AS (SELECT category, sum(rev_cents) AS cat_cents FROM g_pp_base GROUP BY category),
g_product_performance AS (
  SELECT b.product_id, b.product_name, b.category, b.units_sold,
         b.rev_cents / 100 AS revenue_usd,
         CAST(dense_rank() OVER (PARTITION BY b.category ORDER BY b.rev_cents DESC) AS INTEGER)
           AS rank_in_category,
         COALESCE(CASE WHEN t.cat_cents > 0 THEN
           ((CAST(b.rev_cents AS HUGEINT) * 20000 + t.cat_cents) // (2 * t.cat_cents)) / 100 END,
           0.0) AS pct_of_category_revenue
  FROM g_pp_base b JOIN g_pp_tot t ON b.category = t.category
)"""

CTES = "WITH " + BRONZE.strip() + "," + SILVER + "," + GOLD + "\n"

ORDER_COLS = (
    "order_id, customer_id, order_date, order_status, sales_channel, currency_code, "
    "shipping_cost, order_total, fx_rate_to_usd, order_total_usd, shipping_cost_usd"
)
ITEM_COLS = (
    "order_item_id, order_id, product_id, quantity, unit_price, discount_pct, line_total, "
    "order_date, line_total_usd"
)


def _q(select: str) -> str:
    return CTES + select


THRESHOLDS = "(VALUES ('products', 3.0), ('customers', 1.5), ('exchange_rates', 0.5), " \
    "('orders', 1.0), ('order_items', 1.0)) th(tbl, threshold_pct)"

GATE_REPORT = f"""
SELECT c.tbl AS "table", c.good, c.quarantined,
       COALESCE(CASE WHEN c.good + c.quarantined > 0 THEN
         ((CAST(c.quarantined AS HUGEINT) * 20000 + (c.good + c.quarantined))
           // (2 * (c.good + c.quarantined))) / 100 END, 0.0) AS quarantine_pct,
       CAST(th.threshold_pct AS DOUBLE) AS threshold_pct,
       COALESCE(CASE WHEN c.good + c.quarantined > 0 THEN
         ((CAST(c.quarantined AS HUGEINT) * 20000 + (c.good + c.quarantined))
           // (2 * (c.good + c.quarantined))) / 100 END, 0.0) <= th.threshold_pct AS passed
FROM (
  SELECT 'products' AS tbl, count_if(_dq_failed_checks = '') AS good, count_if(_dq_failed_checks <> '') AS quarantined FROM p_flag
  UNION ALL SELECT 'customers', count_if(_dq_failed_checks = ''), count_if(_dq_failed_checks <> '') FROM c_flag
  UNION ALL SELECT 'exchange_rates', count_if(_dq_failed_checks = ''), count_if(_dq_failed_checks <> '') FROM fx_flag
  UNION ALL SELECT 'orders', count_if(_dq_failed_checks = ''), count_if(_dq_failed_checks <> '') FROM o_flag
  UNION ALL SELECT 'order_items', count_if(_dq_failed_checks = ''), count_if(_dq_failed_checks <> '') FROM i_flag
) c JOIN {THRESHOLDS} ON c.tbl = th.tbl
"""

VALIDATE = " UNION ALL ".join(
    f"SELECT '{m}' AS mart, (SELECT count(*) FROM (SELECT 1 FROM g_{m} LIMIT 1)) > 0 AS has_rows"
    for m in ["daily_sales", "customer_360", "monthly_revenue", "inventory_summary", "product_performance"]
)

LIVE = """
SELECT o.customer_id, o.open_order_count, o.open_order_total, o.latest_open_order_date,
       c.country, c.customer_segment, g.lifetime_order_count, g.lifetime_revenue_usd
FROM (SELECT customer_id, count(*) AS open_order_count,
             CAST(sum(order_total) AS DECIMAL(22,2)) AS open_order_total,
             max(order_date) AS latest_open_order_date
      FROM b_orders WHERE order_status IN ('PLACED', 'SHIPPED') GROUP BY customer_id) o
JOIN b_customers c ON o.customer_id = c.customer_id
LEFT JOIN g_customer_360 g ON o.customer_id = g.customer_id
"""

FX_COMPOSITE = """
SELECT rate_date, base_currency, quote_currency, rate FROM (
  SELECT *, row_number() OVER (PARTITION BY rate_date, base_currency, quote_currency
                               ORDER BY _bronze_ingested_at DESC NULLS LAST) AS _rn
  FROM (SELECT rate_date, base_currency, quote_currency, rate, _bronze_ingested_at FROM b_fx
        UNION ALL
        SELECT rate_date, base_currency, quote_currency, stale_rate,
               _bronze_ingested_at - INTERVAL 1 DAY FROM b_fx_all))
WHERE _rn = 1
"""

# First extraction sees orders / rates dated before 1998-01-01; the second
# extracts everything past the stored watermark.
FIRST_CUTOFF = "DATE '1998-01-01'"
ORDERS_WM1 = f"(SELECT max(order_ts) FROM b_orders WHERE order_date < {FIRST_CUTOFF})"

BRONZE_HISTORY = f"""
SELECT CASE WHEN order_date < {FIRST_CUTOFF} THEN 'b1' ELSE 'b2' END AS batch_id,
       count(*) AS "rows", min(order_ts) AS min_order_ts, max(order_ts) AS max_order_ts
FROM b_orders GROUP BY 1
"""

INCREMENTAL = f"""
SELECT order_id, customer_id, order_ts, order_status, currency_code, order_total
FROM b_orders WHERE order_ts > {ORDERS_WM1}
"""

WATERMARKS = """
SELECT 'orders' AS source_table, CAST(max(order_ts) AS VARCHAR) AS watermark_value FROM b_orders
UNION ALL
SELECT 'exchange_rates', CAST(max(rate_date) AS VARCHAR) FROM b_fx
"""


ITEMS_AUDIT = """
SELECT 'tpch-lineitem' AS bronze_source, '2002-01-01 00:00:00' AS bronze_ingested_at, '2002-01-01' AS bronze_ingested_date,
       'b1' AS batch_id, count(*) AS "rows", count(*) AS rows_reported, CAST(sum(quantity) AS BIGINT) AS quantity,
       min(order_item_id) AS first_id, max(order_item_id) AS last_id
FROM b_items
"""

CUSTOMERS_SECOND = """
SELECT customer_id, first_name, last_name, email, country, city, signup_date, customer_segment, is_active
FROM b_customers WHERE customer_id > (SELECT max(customer_id) FROM b_customers WHERE customer_id < 100)
"""

PRODUCTS = "SELECT product_id, product_name, category, subcategory, brand, unit_cost, list_price, is_active FROM b_products"

FX_CSV = """
SELECT rate_date, base_currency, quote_currency, rate, 1 AS copies FROM b_fx
UNION ALL
SELECT DISTINCT CAST(NULL AS DATE), base_currency, quote_currency, CAST(1 AS DECIMAL(12,6)), 2 FROM b_fx
"""

FX_CSV_LINES = """
SELECT DISTINCT quote_currency, 'rate_date_not_null' AS _dq_failed_checks,
       'no date,' || base_currency || ',' || quote_currency || ',1.000000' AS line, batch_id
FROM b_fx, (VALUES ('b1'), ('b2')) AS runs(batch_id)
"""

STORE_ORDERS = f"""
SELECT strftime(order_date, '%Y-%m') AS "month", count(*) AS "rows",
       CAST(sum({cents('order_total_usd')}) AS BIGINT) AS total_cents,
       min(order_date) AS first_date, max(order_date) AS last_date
FROM o_good GROUP BY 1
"""

MARTS = " UNION ALL ".join(
    f"SELECT '{m}' AS mart, count(*) AS \"rows\", CAST(sum({cents(c)}) AS BIGINT) AS revenue_cents FROM g_{m}"
    for m, c in [
        ("daily_sales", "total_revenue_usd"), ("customer_360", "lifetime_revenue_usd"), ("monthly_revenue", "total_revenue_usd"),
        ("inventory_summary", "lifetime_revenue_usd"), ("product_performance", "revenue_usd"),
    ]
)


def _all_fire() -> str:
    """The silver SQL over tables that also hold the broken rows."""
    names = {"customers": "b_customers", "products": "b_products", "exchange_rates": "b_fx", "orders": "b_orders", "order_items": "b_items"}
    ctes, unions = BRONZE.strip(), []
    for table, view in names.items():
        ctes = ctes.replace(f"{view} AS (", f"raw_{view} AS (")
        extra = [
            f"SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in change.items())}) FROM raw_{view} WHERE {which}"
            for change, which in variants(table)
        ]
        unions.append(f"{view} AS (SELECT * FROM raw_{view} UNION ALL {' UNION ALL '.join(extra)})")
    flags = {"customers": "c_flag", "products": "p_flag", "exchange_rates": "fx_flag", "orders": "o_flag", "order_items": "i_flag"}
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", _dq_failed_checks AS failed, count(*) AS \"rows\" FROM {f} GROUP BY 2" for t, f in flags.items()
    )
    return "WITH " + ctes + ", " + ", ".join(unions) + "," + SILVER + "\n" + counts


#: What two incremental runs leave is what one pass over all rows gives.
AS_IN_ONE_PASS = {
    "silver_incremental_orders": "silver_orders",
    "quarantine_incremental_order_items": "quarantine_order_items",
    "gold_incremental_daily_sales": "gold_daily_sales",
    "gold_incremental_customer_360": "gold_customer_360",
    "gold_incremental_product_performance": "gold_product_performance",
}


def oracle_sql() -> dict[str, str]:
    found = _one_pass()
    return found | {name: found[same] for name, same in AS_IN_ONE_PASS.items()}


def _one_pass() -> dict[str, str]:
    return {
        "bronze_replay_history": _q(BRONZE_HISTORY),
        "bronze_compacted_history": _q(BRONZE_HISTORY),
        "bronze_items_audit": _q(ITEMS_AUDIT),
        "bronze_customers_incremental": _q(CUSTOMERS_SECOND),
        "bronze_products_csv": _q(PRODUCTS),
        "bronze_fx_csv": _q(FX_CSV),
        "quarantine_fx_csv_lines": _q(FX_CSV_LINES),
        "checks_all_fire": _all_fire(),
        "silver_store_orders": _q(STORE_ORDERS),
        "quarantine_store_orders": _q("SELECT order_id, customer_id, order_date, _dq_failed_checks FROM o_flag WHERE _dq_failed_checks <> ''"),
        "gate_from_store": _q(GATE_REPORT),
        "pipeline_marts": _q(MARTS),
        "dedupe_fx_composite": _q(FX_COMPOSITE),
        "dq_gate_report": _q(GATE_REPORT),
        "validate_outputs": _q(VALIDATE),
        "live_customer_orders": _q(LIVE),
        "bronze_append_history": _q(BRONZE_HISTORY),
        "incremental_orders": _q(INCREMENTAL),
        "watermark_latest": _q(WATERMARKS),
        "gold_daily_sales": _q("SELECT * FROM g_daily_sales"),
        "gold_customer_360": _q("SELECT * FROM g_customer_360"),
        "gold_monthly_revenue": _q("SELECT * FROM g_monthly_revenue"),
        "gold_inventory_summary": _q("SELECT * FROM g_inventory_summary"),
        "gold_product_performance": _q("SELECT * FROM g_product_performance"),
        "silver_orders": _q(f"SELECT {ORDER_COLS} FROM o_good"),
        "quarantine_orders": _q(f"SELECT {ORDER_COLS}, _dq_failed_checks FROM o_flag WHERE _dq_failed_checks <> ''"),
        "silver_order_items": _q(f"SELECT {ITEM_COLS} FROM i_good"),
        "quarantine_order_items": _q(f"SELECT {ITEM_COLS}, _dq_failed_checks FROM i_flag WHERE _dq_failed_checks <> ''"),
        "silver_customers": _q(
            "SELECT customer_id, first_name, last_name, email, country, city, signup_date, "
            "customer_segment, is_active FROM c_good"
        ),
        "quarantine_customers": _q(
            "SELECT customer_id, first_name, last_name, email, country, city, signup_date, "
            "customer_segment, is_active, _dq_failed_checks FROM c_flag WHERE _dq_failed_checks <> ''"
        ),
        "silver_products": _q(
            "SELECT product_id, product_name, category, subcategory, brand, unit_cost, list_price, "
            "is_active FROM p_good"
        ),
        "quarantine_products": _q(
            "SELECT product_id, product_name, category, subcategory, brand, unit_cost, list_price, "
            "is_active, _dq_failed_checks FROM p_flag WHERE _dq_failed_checks <> ''"
        ),
        "silver_exchange_rates": _q(
            "SELECT rate_date, base_currency, quote_currency, rate FROM fx_good"
        ),
        "dq_split_customers": _q("SELECT customer_id, _dq_failed_checks FROM c_flag"),
        "dq_split_products": _q("SELECT product_id, _dq_failed_checks FROM p_flag"),
        "dq_split_fx": _q("SELECT rate_date, base_currency, quote_currency, rate, _dq_failed_checks FROM fx_flag"),
        "dedupe_order_items": _q(
            "SELECT order_item_id, order_id, product_id, quantity, line_total, discount_pct FROM i_cand"
        ),
    }
