"""The named data-quality checks of each silver table, and the gate
thresholds.

A table declares its rules in order; a rule makes the check and its name
from the column it is about.

--- Fixed values (must equal the reference's for identical results) ---
Email pattern:        ^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$
Customer segments:    VIP, RETAIL, WHOLESALE
Order statuses:       PLACED, SHIPPED, DELIVERED, CANCELLED, RETURNED
Sales channels:       ONLINE, STORE
FX base currency:     USD
Gate thresholds (% of rows quarantined, per table):
                      products 3.0, customers 1.5, exchange_rates 0.5,
                      orders 1.0, order_items 1.0
Check names and order: as declared below.
--- end of fixed values ---
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.operators.quality import DQCheck

EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
DOMAINS = {
    "customer_segment": ["VIP", "RETAIL", "WHOLESALE"],
    "order_status": ["PLACED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"],
    "sales_channel": ["ONLINE", "STORE"],
}
GATE_THRESHOLDS_PCT = {"products": 3.0, "customers": 1.5, "exchange_rates": 0.5, "orders": 1.0, "order_items": 1.0}

# Flag columns produced by the FK probes (J1, J3, J4), by the key they look up.
KNOWN = {"customer_id": "_known_customer", "order_id": "_known_order", "product_id": "_known_product"}

Rule = Callable[[dt.date | None], DQCheck]


def _rule(name: str, test: Callable[[dt.date | None], Column]) -> Rule:
    return lambda as_of: DQCheck(name, test(as_of))


def required(col: str) -> Rule:
    return _rule(f"{col}_not_null", lambda _: F.col(col).isNotNull())


def listed(col: str) -> Rule:
    return _rule(f"{col}_valid", lambda _: F.col(col).isin(DOMAINS[col]))


def not_below_zero(col: str) -> Rule:
    return _rule(f"{col}_non_negative", lambda _: F.col(col) >= 0)


def above_zero(col: str) -> Rule:
    return _rule(f"{col}_positive", lambda _: F.col(col) > 0)


def looked_up(col: str) -> Rule:
    return _rule(f"{col}_exists", lambda _: F.col(KNOWN[col]))


RULES: dict[str, list[Rule]] = {
    "customers": [
        required("customer_id"),
        _rule("email_well_formed", lambda _: F.col("email").rlike(EMAIL_SHAPE)),
        required("signup_date"),
        _rule("signup_date_not_future", lambda as_of: F.col("signup_date") <= F.lit(as_of)),
        listed("customer_segment"),
    ],
    "products": [
        *map(required, ("product_id", "product_name")),
        *map(not_below_zero, ("unit_cost", "list_price")),
        _rule("list_price_gte_unit_cost", lambda _: F.col("list_price") >= F.col("unit_cost")),
    ],
    "exchange_rates": [
        required("rate_date"),
        above_zero("rate"),
        _rule("base_currency_is_usd", lambda _: F.col("base_currency") == "USD"),
    ],
    "orders": [
        required("order_id"),
        looked_up("customer_id"),
        *map(listed, ("order_status", "sales_channel")),
        not_below_zero("order_total"),
        _rule("fx_conversion_resolved", lambda _: F.col("order_total_usd").isNotNull()),
    ],
    "order_items": [
        required("order_item_id"),
        *map(looked_up, ("order_id", "product_id")),
        above_zero("quantity"),
        not_below_zero("unit_price"),
    ],
}


def checks_of(table: str, as_of: dt.date | None = None, implied: tuple[str, ...] = ()) -> list[DQCheck]:
    """The table's checks in order.  ``implied``: keys whose look-up a
    consumer makes itself, by joining the other side's good rows."""
    skip = {f"{k}_exists" for k in implied}
    return [c for c in (rule(as_of) for rule in RULES[table]) if c.name not in skip]
