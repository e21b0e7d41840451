import datetime as dt

import pytest

from fixtures import CUSTOMERS, FX, ITEMS, ORDERS, PRODUCTS, customer, frame, fx, item, order, product
from strata.plans import silver

AS_OF = dt.date(2026, 1, 31)


def failed(split, key):
    return {r[key]: r["_dq_failed_checks"] for r in split.quarantine.collect()}


@pytest.mark.parametrize(
    "row, check",
    [
        (customer(None), "customer_id_not_null"),
        (customer(2, email="no-at-sign"), "email_well_formed"),
        (customer(3, email=None), "email_well_formed"),
        (customer(4, signup=None), "signup_date_not_null,signup_date_not_future"),
        (customer(5, signup=dt.date(2026, 2, 1)), "signup_date_not_future"),
        (customer(6, segment="GOLD"), "customer_segment_valid"),
    ],
)
def test_each_customer_check_fails_alone(spark, row, check):
    s = silver.silver_customers(frame(spark, CUSTOMERS, [customer(1), row]), AS_OF)
    assert [r["customer_id"] for r in s.good.collect()] == [1]
    assert list(failed(s, "customer_id").values()) == [check]


@pytest.mark.parametrize(
    "row, check",
    [
        (product(None), "product_id_not_null"),
        (product(2, name=None), "product_name_not_null"),
        (product(3, cost="-1.00"), "unit_cost_non_negative"),
        (product(4, cost="0.00", price="-1.00"), "list_price_non_negative,list_price_gte_unit_cost"),
        (product(5, cost="11.00", price="10.00"), "list_price_gte_unit_cost"),
        (product(6, cost=None), "unit_cost_non_negative,list_price_gte_unit_cost"),
    ],
)
def test_each_product_check_fails_alone(spark, row, check):
    s = silver.silver_products(frame(spark, PRODUCTS, [product(1), row]))
    assert [r["product_id"] for r in s.good.collect()] == [1]
    assert list(failed(s, "product_id").values()) == [check]


@pytest.mark.parametrize(
    "row, check",
    [
        (fx("GBP", "0.79", day=None), "rate_date_not_null"),
        (fx("GBP", "0"), "rate_positive"),
        (fx("GBP", None), "rate_positive"),
        (fx("GBP", "0.79", base="EUR"), "base_currency_is_usd"),
    ],
)
def test_each_fx_check_fails_alone(spark, row, check):
    s = silver.silver_exchange_rates(frame(spark, FX, [fx("EUR", "0.92"), row]))
    assert [r["quote_currency"] for r in s.good.collect()] == ["EUR"]
    assert list(failed(s, "quote_currency").values()) == [check]


def _orders_env(spark):
    customers = silver.silver_customers(frame(spark, CUSTOMERS, [customer(1)]), AS_OF).good
    rates = silver.silver_exchange_rates(frame(spark, FX, [fx("EUR", "0.800000")])).good
    return customers, rates


@pytest.mark.parametrize(
    "row, check",
    [
        (order(None), "order_id_not_null"),
        (order(2, cid=99), "customer_id_exists"),
        (order(3, status="LOST"), "order_status_valid"),
        (order(4, channel="PHONE"), "sales_channel_valid"),
        (order(5, total="-1.00"), "order_total_non_negative"),
        (order(6, cur="EUR", day=dt.date(2026, 1, 6)), "fx_conversion_resolved"),
        (order(7, cur="JPY"), "fx_conversion_resolved"),
    ],
)
def test_each_order_check_fails_alone(spark, row, check):
    customers, rates = _orders_env(spark)
    s = silver.silver_orders(frame(spark, ORDERS, [order(1), row]), customers, rates)
    assert [r["order_id"] for r in s.good.collect()] == [1]
    assert list(failed(s, "order_id").values()) == [check]


def test_fx_conversion_usd_at_par_and_eur_by_rate(spark):
    customers, rates = _orders_env(spark)
    s = silver.silver_orders(
        frame(spark, ORDERS, [order(1, total="100.00"), order(2, cur="EUR", total="100.00", ship="1.00")]),
        customers,
        rates,
    )
    got = {r["order_id"]: (r["fx_rate_to_usd"], r["order_total_usd"], r["shipping_cost_usd"]) for r in s.good.collect()}
    assert got == {1: (1.0, 100.0, 5.0), 2: (0.8, 125.0, 1.25)}
    assert "rate" not in s.good.columns and "_known_customer" not in s.good.columns


def test_null_keys_are_not_collapsed_by_dedupe(spark):
    customers, rates = _orders_env(spark)
    rows = [order(None, total="1.00"), order(None, total="2.00"), order(1)]
    s = silver.silver_orders(frame(spark, ORDERS, rows), customers, rates)
    assert s.quarantine.count() == 2 and s.good.count() == 1


@pytest.mark.parametrize(
    "row, check",
    [
        (item(None), "order_item_id_not_null"),
        (item(2, oid=99), "order_id_exists"),
        (item(3, pid=99), "product_id_exists"),
        (item(4, qty=0), "quantity_positive"),
        (item(5, price="-0.01"), "unit_price_non_negative"),
        (item(6, price=None), "unit_price_non_negative"),
    ],
)
def test_each_order_item_check_fails_alone(spark, row, check):
    customers, rates = _orders_env(spark)
    orders = silver.silver_orders(frame(spark, ORDERS, [order(1, cur="EUR")]), customers, rates).good
    products = silver.silver_products(frame(spark, PRODUCTS, [product(1)])).good
    s = silver.silver_order_items(frame(spark, ITEMS, [item(1), row]), orders, products)
    good = s.good.collect()
    assert [r["order_item_id"] for r in good] == [1]
    assert good[0]["line_total_usd"] == 12.5 and good[0]["order_date"] == dt.date(2026, 1, 5)
    assert list(failed(s, "order_item_id").values()) == [check]


def test_quarantined_order_quarantines_its_items(spark):
    customers, rates = _orders_env(spark)
    orders = silver.silver_orders(frame(spark, ORDERS, [order(1, cid=42)]), customers, rates)
    assert orders.good.count() == 0
    products = silver.silver_products(frame(spark, PRODUCTS, [product(1)])).good
    s = silver.silver_order_items(frame(spark, ITEMS, [item(1), item(2)]), orders.good, products)
    assert set(failed(s, "order_item_id").values()) == {"order_id_exists"}
