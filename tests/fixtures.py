"""Hand-built bronze rows with the source schemas (plus audit columns)."""
import datetime as dt
import re
from decimal import Decimal as D

TS = dt.datetime(2026, 1, 10, 12, 0, 0)
AUDIT = ", _bronze_ingested_at TIMESTAMP, _bronze_source STRING"

ORDERS = (
    "order_id BIGINT, customer_id BIGINT, order_date DATE, order_ts TIMESTAMP, order_status STRING, "
    "sales_channel STRING, currency_code STRING, shipping_cost DECIMAL(10,2), order_total DECIMAL(12,2)" + AUDIT
)
ITEMS = (
    "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DECIMAL(10,2), "
    "discount_pct DECIMAL(4,3), line_total DECIMAL(12,2)" + AUDIT
)
CUSTOMERS = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, country STRING, city STRING, "
    "signup_date DATE, customer_segment STRING, is_active BOOLEAN" + AUDIT
)
PRODUCTS = (
    "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, brand STRING, "
    "unit_cost DECIMAL(10,2), list_price DECIMAL(10,2), is_active BOOLEAN" + AUDIT
)
FX = "rate_date DATE, base_currency STRING, quote_currency STRING, rate DECIMAL(12,6)" + AUDIT

DAY = dt.date(2026, 1, 5)


def customer(cid, email="a@b.co", signup=dt.date(2025, 1, 1), segment="VIP", ts=TS, **kw):
    row = dict(customer_id=cid, first_name="F", last_name="L", email=email, country="X", city="Y",
               signup_date=signup, customer_segment=segment, is_active=True,
               _bronze_ingested_at=ts, _bronze_source="test")
    row.update(kw)
    return row


def product(pid, name="p", cost="5.00", price="10.00", category="TOYS", ts=TS):
    return dict(product_id=pid, product_name=name, category=category, subcategory="s", brand="b",
                unit_cost=None if cost is None else D(cost), list_price=None if price is None else D(price),
                is_active=True, _bronze_ingested_at=ts, _bronze_source="test")


def fx(quote, rate, day=DAY, base="USD", ts=TS):
    return dict(rate_date=day, base_currency=base, quote_currency=quote,
                rate=None if rate is None else D(rate), _bronze_ingested_at=ts, _bronze_source="test")


def order(oid, cid=1, day=DAY, status="PLACED", channel="ONLINE", cur="USD", total="100.00",
          ship="5.00", ts=TS):
    return dict(order_id=oid, customer_id=cid, order_date=day,
                order_ts=None if day is None else dt.datetime.combine(day, dt.time()),
                order_status=status, sales_channel=channel, currency_code=cur,
                shipping_cost=D(ship), order_total=None if total is None else D(total),
                _bronze_ingested_at=ts, _bronze_source="test")


def item(iid, oid=1, pid=1, qty=1, price="10.00", total="10.00", ts=TS):
    return dict(order_item_id=iid, order_id=oid, product_id=pid, quantity=qty,
                unit_price=None if price is None else D(price), discount_pct=D("0.000"),
                line_total=D(total), _bronze_ingested_at=ts, _bronze_source="test")


def frame(spark, schema, rows):
    cols = re.findall(r"(\w+)\s+[A-Za-z]+(?:\([^)]*\))?", schema)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
