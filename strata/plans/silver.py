"""V-*: silver transforms as pure functions.

Each returns a ``Silver``: ``flagged`` holds every candidate row with its
failed checks, ``quarantine`` is a filter of it, and a writer that
persists ``flagged`` evaluates dedupe, joins and checks once.

Order of work per table: split off NULL-key rows (they bypass D1 and are
quarantined by the key's not-null check, H4), D1 on the rest, FK probes
and FX lookup, checks.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.audit import BATCH_ID, INGESTED_AT, INGESTED_DATE, SOURCE
from strata.operators.dedupe import dedupe_latest, split_null_keys
from strata.operators.enrich import FX_RATE, attach, flag_known, fx_rate_column, fx_to_usd
from strata.operators.quality import FAILED, DQCheck, flag_dq
from strata.plans.checks import KNOWN, checks_of


class Silver:
    """A silver table's rows, flagged by its checks.

    ``keyed`` holds the deduplicated rows whose key is set, ``nulls`` the
    rows whose (checked) key is NULL; ``finish`` turns candidates into
    flagged rows (lookups + checks).  NULL-key rows always fail the key's
    not-null check, so ``good`` is built from ``keyed`` alone: its plan has
    no union and keeps the dedupe's hash partitioning on the key, which
    later joins on that key reuse instead of shuffling again.
    """

    def __init__(
        self,
        keyed: DataFrame,
        nulls: DataFrame | None,
        finish: Callable[[DataFrame], DataFrame],
    ):
        self._keyed, self._nulls, self._finish = keyed, nulls, finish

    @cached_property
    def flagged(self) -> DataFrame:
        cand = self._keyed if self._nulls is None else self._keyed.unionByName(self._nulls)
        return self._finish(cand)

    @cached_property
    def good(self) -> DataFrame:
        return self._finish(self._keyed).where(F.col(FAILED) == "").drop(FAILED)

    @property
    def quarantine(self) -> DataFrame:
        return self.flagged.where(F.col(FAILED) != "")


def _ties(bronze: DataFrame, key_cols: Sequence[str], first: Sequence[str]) -> list[str]:
    """What decides between rows of one ingestion time: the caller's columns,
    then the batch, then every business column.  Rows that tie in all of
    them are equal, so the winner is fixed however often it is recomputed."""
    own = [c for c in (BATCH_ID, *sorted(bronze.columns)) if c in bronze.columns]
    return list(dict.fromkeys([*first, *[c for c in own if c not in (*key_cols, INGESTED_AT, SOURCE, INGESTED_DATE)]]))


def _silver(
    bronze: DataFrame,
    key_cols: Sequence[str],
    not_null_keys: Sequence[str],
    tie_breakers: Sequence[str],
    checks: Sequence[DQCheck],
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    helpers: Sequence[str] = (),
    null_keyed: DataFrame | None = None,
) -> Silver:
    keyed, nulls = split_null_keys(bronze, not_null_keys)
    cands = dedupe_latest(keyed, key_cols, INGESTED_AT, _ties(bronze, key_cols, tie_breakers))

    def finish(cand: DataFrame) -> DataFrame:
        return flag_dq(enrich(cand) if enrich else cand, checks).drop(*helpers)

    return Silver(cands, nulls if null_keyed is None else null_keyed, finish)


def silver_customers(bronze: DataFrame, as_of: dt.date, tie_breakers: Sequence[str] = ()) -> Silver:
    key = ["customer_id"]
    return _silver(bronze, key, key, tie_breakers, checks_of("customers", as_of))


def silver_products(bronze: DataFrame, tie_breakers: Sequence[str] = ()) -> Silver:
    key = ["product_id"]
    return _silver(bronze, key, key, tie_breakers, checks_of("products"))


FX_KEYS = ["rate_date", "base_currency", "quote_currency"]


def silver_exchange_rates(bronze: DataFrame, tie_breakers: Sequence[str] = ()) -> Silver:
    # Only rate_date has a not-null check; NULL quote/base rows still
    # go through D1 as one group per remaining key values.
    return _silver(bronze, FX_KEYS, ["rate_date"], tie_breakers, checks_of("exchange_rates"))


def silver_orders(
    bronze: DataFrame,
    customers: DataFrame | None,
    exchange_rates: DataFrame,
    tie_breakers: Sequence[str] = (),
) -> Silver:
    """D1 -> J1 (customer exists) -> J2 (rate of the order date) -> C1 -> checks.

    ``customers`` and ``exchange_rates`` are the *good* silver frames.
    Without ``customers`` J1 and its check are left out: for consumers that
    sum per customer first and join the good customers themselves.
    """
    def enrich(cand: DataFrame) -> DataFrame:
        if customers is not None:
            cand = flag_known(cand, customers, "customer_id", "customer_id", KNOWN["customer_id"])
        cand = attach(
            cand,
            exchange_rates,
            on=[("order_date", "rate_date"), ("currency_code", "quote_currency")],
            columns=["rate"],
        )
        return fx_to_usd(cand.withColumn(FX_RATE, fx_rate_column()), ["order_total", "shipping_cost"])

    key = ["order_id"]
    checks = checks_of("orders", implied=("customer_id",) if customers is None else ())
    return _silver(bronze, key, key, tie_breakers, checks, enrich, [KNOWN["customer_id"], "rate"])


def silver_order_items(
    bronze: DataFrame,
    orders: DataFrame | None,
    products: DataFrame | None,
    tie_breakers: Sequence[str] = (),
    null_keyed: DataFrame | None = None,
) -> Silver:
    """D1 -> J3 (order exists; carries order_date and its rate) ->
    J4 (product exists) -> C1 -> checks.  ``orders``/``products`` are the
    good silver frames; without one of them its join and check are left out
    (see ``silver_orders``; without ``orders`` there is no USD amount).
    ``null_keyed``: the rows without a key, where the caller can read them
    with a filter on source columns."""

    def enrich(cand: DataFrame) -> DataFrame:
        if orders is not None:
            known = orders.select("order_id", "order_date", FX_RATE, F.lit(True).alias(KNOWN["order_id"]))
            cand = attach(
                cand, known, on=[("order_id", "order_id")], columns=["order_date", FX_RATE, KNOWN["order_id"]]
            ).withColumn(KNOWN["order_id"], F.coalesce(F.col(KNOWN["order_id"]), F.lit(False)))
        if products is not None:
            cand = flag_known(cand, products, "product_id", "product_id", KNOWN["product_id"])
        return cand if orders is None else fx_to_usd(cand, ["line_total"])

    implied = tuple(k for k, side in (("order_id", orders), ("product_id", products)) if side is None)
    key = ["order_item_id"]
    return _silver(
        bronze, key, key, tie_breakers, checks_of("order_items", implied=implied), enrich,
        [KNOWN["order_id"], KNOWN["product_id"], FX_RATE], null_keyed,
    )
