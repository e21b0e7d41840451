"""Change-driven silver and merged marts: equal to a rebuild, touched months only."""
import datetime as dt
import os
import shutil
import tempfile
import threading
from collections import Counter

import pytest
from fixtures import CUSTOMERS, FX, ITEMS, ORDERS, PRODUCTS, customer, frame, fx, item, order, product
from pyspark.sql import functions as F

from strata.plans import incremental, mart_state
from strata.plans.bronze import SourceSpec, extract
from strata.plans.jobs import side_by_side
from strata.plans.pipeline import PipelineConfig, build_marts, build_silver, run_pipeline, run_silver
from strata.sources.store import PASSED, TableStore

AS_OF = dt.date(2026, 6, 30)
JAN, FEB, MAR, APR = (dt.date(2026, m, 10) for m in (1, 2, 3, 4))
SCHEMAS = {"customers": CUSTOMERS, "products": PRODUCTS, "exchange_rates": FX, "orders": ORDERS, "order_items": ITEMS}
TABLES = list(SCHEMAS)


def source(table, rows, batch):
    def read(s):
        return frame(s, SCHEMAS[table], rows).drop("_bronze_ingested_at", "_bronze_source").withColumn("seq", F.lit(batch))

    return SourceSpec(table, "test", read, watermark_col=None if table == "products" else "seq")


def load(spark, store, batch, **rows):
    """One extraction; every row of a call is past the mark of the one before."""
    for table, some in rows.items():
        extract(spark, store, source(table, some, batch), run_ts=dt.datetime(2026, 7, batch), batch_id=f"b{batch}")


def cfg(batch, as_of=AS_OF):
    return PipelineConfig(as_of=as_of, run_ts=dt.datetime(2026, 7, batch), incremental=True)


FIRST = dict(
    customers=[customer(1), customer(2), customer(9, email="bad"), customer(8, signup=dt.date(2026, 7, 15)), customer(None)],
    products=[product(1), product(2, cost="20.00"), product(3)],
    exchange_rates=[fx("EUR", "0.5", JAN), fx("EUR", "0.5", FEB)],
    orders=[order(10, 1, JAN), order(11, 2, FEB), order(12, 9, FEB), order(13, 1, MAR, cur="EUR"), order(14, 7, JAN), order(None, 7, FEB),
            order(15, 1, APR), order(16, 8, JAN), order(17, 1, None)],
    order_items=[item(100, 10, 1), item(101, 11, 1), item(102, 13, 1), item(103, 14, 3), item(104, 15, 2), item(105, 15, 1), item(106, 99, 1), item(None, 10, 1),
                 item(107, 17, 3)],
)


def rows_of(df):
    drop = [c for c in ("_silver_processed_at",) if c in df.columns]
    cols = sorted(set(df.columns) - set(drop))
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def same_as_rebuild(store, c):
    """Every stored silver table and mart equals one computed from all of bronze."""
    for t in TABLES:
        whole = build_silver(store, t, c).flagged.withColumn(PASSED, F.col("_dq_failed_checks") == "")
        assert rows_of(store.read_split(t).drop("_month")) == rows_of(whole), t
    for name, df in build_marts(store, c.as_of).items():
        assert rows_of(store.read("gold", name).drop("_gold_computed_at")) == rows_of(df), name


def refresh(store, c):
    done = incremental.refresh_silver(store, c)
    return done, mart_state.refresh_gold(store, c, done)


def files(store, table):
    at = store.split_version(table)
    return {os.path.relpath(os.path.join(d, f), at) for d, _, fs in os.walk(at) for f in fs if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def first_run(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-first-"))
    store.ensure_layers()
    load(spark, store, 1, **FIRST)
    done, summed = refresh(store, cfg(1))
    assert {r.mode for r in done.values()} == {"rebuilt"} and set(summed.values()) == {None}
    return store


@pytest.fixture
def lake(spark, first_run):
    """A copy of the store after its first run."""
    root = f"{tempfile.mkdtemp(prefix='strata-lake-')}/store"
    shutil.copytree(first_run.root, root)
    return TableStore(spark, root)


def test_nothing_new_changes_no_file(lake):
    before = {t: files(lake, t) for t in TABLES}
    done, summed = refresh(lake, cfg(1))
    assert {r.mode for r in done.values()} == {"kept"} and list(summed.values()) == [[], [], []]
    assert {t: files(lake, t) for t in TABLES} == before
    assert (done["orders"].good, done["orders"].bad) == (lake.read("silver", "orders").count(), lake.read("quarantine", "orders").count())


def test_new_rows_and_late_parents_touch_their_months_only(spark, lake):
    """An order moves from January to March, its rate arrives, an unknown
    customer arrives, a bad one is mended, a product becomes bad."""
    before = {t: files(lake, t) for t in ("orders", "order_items")}
    load(spark, lake, 2,
         customers=[customer(7), customer(9)],
         products=[product(1), product(2), product(3, cost="20.00")],
         exchange_rates=[fx("EUR", "0.8", MAR)],
         orders=[order(10, 1, MAR, total="70.00"), order(18, 2, MAR)],
         order_items=[item(108, 18, 1), item(101, 11, 1, qty=5)])
    done, summed = refresh(lake, cfg(2))
    assert done["orders"].mode == done["order_items"].mode == "months" and done["products"].mode == "rebuilt"
    assert set(done["orders"].months) == {"2026-01", "2026-02", "2026-03"}
    assert {f for f in files(lake, "orders") if "2026-04" in f} == {f for f in before["orders"] if "2026-04" in f} != set()
    same_as_rebuild(lake, cfg(2))
    good = {r["order_id"]: r for r in lake.read("silver", "orders").collect()}
    assert {13, 12, 14} <= set(good) and good[13]["fx_rate_to_usd"] == 0.8 and good[10]["order_date"] == MAR
    assert set(summed["sums_by_customer"]) == {"2026-01", "2026-02", "2026-03"}


def test_an_untouched_table_keeps_its_files(spark, lake):
    before = files(lake, "orders")
    load(spark, lake, 2, order_items=[item(109, 15, 1, qty=3)])
    done, summed = refresh(lake, cfg(2))
    assert done["orders"].mode == "kept" and files(lake, "orders") == before
    assert done["order_items"].months == ["2026-04"] == summed["sums_by_product"] and summed["sums_by_customer"] == []
    same_as_rebuild(lake, cfg(2))


def test_the_clock_rejudges_future_signups(spark, lake):
    done, _ = refresh(lake, cfg(2, dt.date(2026, 7, 31)))
    assert done["customers"].months == ["2026-07"] and done["orders"].months == ["2026-01"]
    same_as_rebuild(lake, cfg(2, dt.date(2026, 7, 31)))
    done, _ = refresh(lake, cfg(3))  # and back
    assert done["customers"].mode == "months"
    same_as_rebuild(lake, cfg(3))


def test_a_repeated_batch_or_a_plain_rebuild_in_between_is_rebuilt(spark, lake):
    load(spark, lake, 2, orders=[order(20, 1, JAN)])
    refresh(lake, cfg(2))
    load(spark, lake, 2, orders=[order(21, 1, FEB)])  # the same batch id, other rows
    done, _ = refresh(lake, cfg(2))
    assert done["orders"].mode == "rebuilt" and done["customers"].mode == "kept"
    same_as_rebuild(lake, cfg(2))
    run_silver(lake, cfg(2), ["customers"])
    done, _ = refresh(lake, cfg(2))
    assert done["customers"].mode == "rebuilt" and done["orders"].mode == "rebuilt"
    same_as_rebuild(lake, cfg(2))


@pytest.mark.parametrize("at,call", [("_move", 2), ("log", 2)])
def test_a_refresh_that_dies_is_rebuilt(spark, lake, monkeypatch, at, call):
    """In the swap of months, or before its last note: what is read meanwhile
    is whole, and the next refresh mends it."""
    load(spark, lake, 2, orders=[order(10, 1, MAR), order(22, 2, JAN)])
    real, calls = getattr(lake, at), []

    def die(*args, **kw):
        calls.append(args)
        if len(calls) == call:
            raise RuntimeError("lost")
        return real(*args, **kw)

    with monkeypatch.context() as m:
        m.setattr(lake, at, die)
        with pytest.raises(RuntimeError):
            incremental.refresh_silver(lake, cfg(2))
    if lake.exists("silver", "orders"):
        ids = [r["order_id"] for r in lake.read("silver", "orders").collect()]
        assert len(ids) == len(set(ids))
    refresh(lake, cfg(2))
    same_as_rebuild(lake, cfg(2))


def test_marts_that_missed_a_refresh_are_summed_anew(spark, lake):
    load(spark, lake, 2, orders=[order(23, 1, JAN)])
    incremental.refresh_silver(lake, cfg(2))  # and gold is not reached
    load(spark, lake, 3, orders=[order(24, 1, FEB)])
    _, summed = refresh(lake, cfg(3))
    assert summed["sums_by_day"] is None and summed["sums_by_customer"] is None and summed["sums_by_product"] == []
    same_as_rebuild(lake, cfg(3))


def test_whole_rows_are_written_once_and_only_stored_keys_are_kept(spark, lake, monkeypatch):
    """Many new orders beside a few stored ones: what a refresh keeps aside is
    look-up columns, and of the new keys those that the table already has."""
    kept, staged = [], []
    save, stage = incremental._saved, lake.stage
    monkeypatch.setattr(incremental, "_saved", lambda df: kept.append((df.columns, (out := save(df)).count())) or out)
    monkeypatch.setattr(lake, "stage", lambda path, df, by: staged.append((path, (out := stage(path, df, by)).count())) or out)
    load(spark, lake, 2, orders=[order(10, 1, MAR)] + [order(i, 2, FEB) for i in range(100, 140)])
    done = incremental.refresh_silver(lake, cfg(2))
    assert set(done["orders"].months) == {"2026-01", "2026-02", "2026-03"}
    assert not [c for c, _ in kept if "order_total" in c or "quantity" in c]
    assert [n for c, n in kept if c == ["_k0"]][0] == 1
    assert [(p.rsplit("/", 1)[-1], n) for p, n in staged if "/orders/" in p] == [("marked", 3), ("judged", 41), ("rest", 6)]
    assert not [c for c in os.listdir(f"{lake.root}/silver/orders") if c.startswith("_staged")]
    refresh(lake, cfg(2))
    same_as_rebuild(lake, cfg(2))


CLEAN = dict(
    customers=[customer(i) for i in range(1, 4)], products=[product(i) for i in range(1, 4)],
    exchange_rates=[fx("EUR", "0.5", JAN)], orders=[order(i, 1 + i % 3, JAN) for i in range(1, 30)],
    order_items=[item(i, i, 1 + i % 3) for i in range(1, 30)],
)


@pytest.mark.parametrize("incremental_run", [False, True])
def test_a_run_passes_the_real_gate_and_names_its_batches(spark, store, incremental_run):
    c = PipelineConfig(as_of=AS_OF, run_ts=dt.datetime(2026, 7, 1), incremental=incremental_run)
    result = run_pipeline(spark, store, [source(t, r, 1) for t, r in CLEAN.items()], c, batch_id="2026-07-01")
    assert all(r["passed"] for r in result.gate) and len(result.gold) == 5
    assert {r.batch_id for r in result.bronze} == {"2026-07-01"}
    assert {r["_batch_id"] for r in store.read("bronze", "orders").select("_batch_id").distinct().collect()} == {"2026-07-01"}
    same_as_rebuild(store, c) if incremental_run else None


def test_jobs_run_side_by_side_and_report_all_errors(spark):
    meet = threading.Barrier(3, timeout=60)
    pools = side_by_side(
        spark, {n: (lambda n=n: (meet.wait(), spark.range(10).count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool"))[1:]) for n in "abc"}
    )
    assert pools == {n: (10, n) for n in "abc"}

    def fail(n):
        raise ValueError(n)

    with pytest.raises(ExceptionGroup) as e:
        side_by_side(spark, {"x": lambda: fail("x"), "y": lambda: 1, "z": lambda: fail("z")})
    assert [str(x) for x in e.value.exceptions] == ["x", "z"]
    with pytest.raises(ValueError, match="x"):
        side_by_side(spark, {"x": lambda: fail("x"), "y": lambda: 1})
