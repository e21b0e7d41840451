"""Two-run incremental extraction from JDBC (embedded in-memory Derby,
no port) and CSV, full refresh, empty runs, replays, pushdown."""
import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans.bronze import SourceSpec, extract
from strata.sources import batches, files, jdbc
from strata.sources import watermark as wm

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _derby_url():
    return f"jdbc:derby:memory:strata{uuid.uuid4().hex[:8]};create=true"


def _seed_orders(spark, url, rows):
    df = spark.createDataFrame(rows, "ORDER_ID BIGINT, CUSTOMER_ID INT, ORDER_TS TIMESTAMP, ORDER_TOTAL INT")
    df.write.jdbc(url, "ORDERS", mode="append", properties=DERBY)


def test_jdbc_incremental_two_runs_then_empty_then_replay(spark, store):
    url = _derby_url()
    t = lambda d: dt.datetime(2026, 1, d)
    _seed_orders(spark, url, [(1, 1, t(1), 10), (2, 1, t(2), 20)])
    spec = SourceSpec("orders", "derby-orders", lambda s: jdbc.jdbc_scan(s, url, "ORDERS", DERBY), watermark_col="ORDER_TS")

    r1 = extract(spark, store, spec, run_ts=t(3), batch_id="b1")
    assert (r1.rows, r1.watermark_before, r1.watermark_after) == (2, None, "2026-01-02 00:00:00")

    _seed_orders(spark, url, [(3, 2, t(4), 30)])
    r2 = extract(spark, store, spec, run_ts=t(5), batch_id="b2")
    assert (r2.rows, r2.watermark_after) == (1, "2026-01-04 00:00:00")

    r3 = extract(spark, store, spec, run_ts=t(6), batch_id="b3")
    assert (r3.rows, r3.watermark_after) == (0, "2026-01-04 00:00:00")
    assert wm.get_watermark(store, "orders") == "2026-01-04 00:00:00"

    bronze = store.read("bronze", "orders")
    assert sorted(r["ORDER_ID"] for r in bronze.collect()) == [1, 2, 3]
    assert {r["_batch_id"] for r in bronze.collect()} == {"b1", "b2"}
    assert {"_bronze_ingested_at", "_bronze_source", "_bronze_ingested_date"} <= set(bronze.columns)

    # Replaying batch b2 re-reads its own interval into its own partition,
    # also after midnight and after a later (empty) batch.
    r4 = extract(spark, store, spec, run_ts=t(9), batch_id="b2")
    assert (r4.rows, r4.watermark_after) == (1, "2026-01-04 00:00:00")
    again = store.read("bronze", "orders")
    assert again.count() == 3 and {str(r["_bronze_ingested_date"]) for r in again.collect()} == {"2026-01-03", "2026-01-05"}
    assert wm.get_watermark(store, "orders") == "2026-01-04 00:00:00"


def _ids(store, table="t"):
    return sorted(r["id"] for r in store.read("bronze", table).collect())


def _numbers(spark_rows):
    return SourceSpec("t", "numbers", lambda s: s.createDataFrame([(i,) for i in spark_rows], "id INT"), watermark_col="id")


def test_one_batch_id_twice_keeps_all_rows(spark, store):
    extract(spark, store, _numbers([1, 2, 3]), batch_id="daily")
    r = extract(spark, store, _numbers([1, 2, 3, 4, 5]), batch_id="daily")
    assert _ids(store) == [1, 2, 3, 4, 5] and (r.rows, r.watermark_after) == (5, "5")


def test_replaying_an_older_batch_takes_no_later_rows(spark, store):
    extract(spark, store, _numbers([1, 2]), batch_id="a")
    extract(spark, store, _numbers([1, 2, 3, 4]), batch_id="b")
    extract(spark, store, _numbers([1, 2, 3, 4, 5]), batch_id="a")
    assert _ids(store) == [1, 2, 3, 4] and wm.get_watermark(store, "t") == "4"
    extract(spark, store, _numbers([1, 2, 3, 4, 5]), batch_id="c")
    assert _ids(store) == [1, 2, 3, 4, 5]


def _die(*_, **__):
    raise RuntimeError("lost")


def _fresh(store):
    for layer, table in (("bronze", "t"), ("control", "watermarks"), ("control", "batches")):
        store._delete(store.table_path(layer, table))


@pytest.mark.parametrize("at", ["append", "set_watermark", "commit_batch"])
@pytest.mark.parametrize("own_id,next_id", [("d1", "d2"), (None, None), (None, "d2")])
def test_a_run_that_dies_at_any_write_loses_and_doubles_nothing(spark, store, monkeypatch, at, own_id, next_id):
    """The first run or a later one dies at one of its three writes; the next
    brings its own batch id or none."""
    for have in ([], [1, 2]):
        _fresh(store)
        if have:
            extract(spark, store, _numbers(have), batch_id="d0")
        with monkeypatch.context() as m:
            m.setattr({"append": store, "set_watermark": wm, "commit_batch": batches}[at], at, _die)
            with pytest.raises(RuntimeError):
                extract(spark, store, _numbers([*have, 3]), batch_id=own_id)
        extract(spark, store, _numbers([*have, 3, 4, 5]), batch_id=next_id)
        assert _ids(store) == [*have, 3, 4, 5] and wm.get_watermark(store, "t") == "5"
        assert extract(spark, store, _numbers([*have, 3, 4, 5]), batch_id="d3").rows == 0


@pytest.mark.parametrize("at", ["append", "set_watermark", "commit_batch"])
@pytest.mark.parametrize("next_id", [None, "d2"])
def test_a_repeated_batch_that_dies_loses_and_doubles_nothing(spark, store, monkeypatch, at, next_id):
    extract(spark, store, _numbers([1, 2]), batch_id="d1")
    with monkeypatch.context() as m:
        m.setattr({"append": store, "set_watermark": wm, "commit_batch": batches}[at], at, _die)
        with pytest.raises(RuntimeError):
            extract(spark, store, _numbers([1, 2, 3]), batch_id="d1")
    extract(spark, store, _numbers([1, 2, 3, 4]), batch_id=next_id)
    assert _ids(store) == [1, 2, 3, 4] and wm.get_watermark(store, "t") == "4"


def test_an_abandoned_batch_begins_anew(spark, store, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(wm, "set_watermark", _die)
        with pytest.raises(RuntimeError):
            extract(spark, store, _numbers([1]), batch_id="a")
    extract(spark, store, _numbers([1, 2]), batch_id="b")
    extract(spark, store, _numbers([1, 2, 3]), batch_id="a")
    extract(spark, store, _numbers([1, 2, 3]), batch_id="a")  # again: from 2, not from the start
    assert _ids(store) == [1, 2, 3]


def test_logs_stay_few_files(spark, store):
    import glob

    for i in range(20):
        wm.set_watermark(store, "t", str(i), batch_id=f"b{i}")
        wm.set_watermark(store, "u", str(-i), batch_id=f"b{i}")
    for table in ("t", "u"):
        assert len(glob.glob(f"{store.table_path('control', 'watermarks')}/source_table={table}/*.parquet")) <= 16
    assert wm.log(store).count() == 40 and wm.get_watermark(store, "t") == "19" and wm.get_watermark(store, "u") == "-19"


def test_partition_values_keep_their_type(spark, store):
    extract(spark, store, _numbers([1]), batch_id="0001")
    extract(spark, store, _numbers([1, 2]), batch_id="20260110")
    extract(spark, store, _numbers([1, 2, 3]), batch_id="12e4")
    assert {r["_batch_id"] for r in store.read("bronze", "t").collect()} == {"0001", "20260110", "12e4"}


def test_a_batch_without_marks_sets_none(spark, store):
    spec = lambda rows: SourceSpec("t", "s", lambda s: s.createDataFrame(rows, "id INT, x INT"), watermark_col="id")
    r = extract(spark, store, spec([(None, 1)]), batch_id="a")
    assert r.rows == 1 and r.watermark_after is None and wm.get_watermark(store, "t") is None
    r = extract(spark, store, spec([(None, 1), (7, 2)]), batch_id="b")
    assert r.watermark_after == "7"
    assert extract(spark, store, spec([(7, 2), (8, 3)]), batch_id="c").rows == 1


def test_overlap_of_a_numeric_mark(spark, store):
    spec = lambda rows: SourceSpec("t", "s", lambda s: s.createDataFrame([(i,) for i in rows], "id INT"), watermark_col="id", overlap="2")
    extract(spark, store, spec([1, 5, 6]), batch_id="a")
    r = extract(spark, store, spec([1, 4, 5, 6, 7]), batch_id="b")
    assert (r.rows, r.watermark_after) == (3, "7")  # 5 and 6 again, 7 new


def test_malformed_rate_dates_reach_the_quarantine_on_every_run(spark, store):
    from strata.plans import silver

    p = _write_csv("rate_date,base_currency,quote_currency,rate\n2024-01-01,USD,EUR,0.92\noops,USD,GBP,0.7\n")
    spec = SourceSpec("exchange_rates", "fx-csv", lambda s: files.exchange_rates_csv(s, p), watermark_col="rate_date", keep_unmarked=True)
    extract(spark, store, spec, batch_id="b1")
    with open(p, "a") as fh:
        fh.write("2024-01-02,USD,EUR,0.93\nbroken,USD,CHF,0.8\n")
    extract(spark, store, spec, batch_id="b2")
    bad = silver.silver_exchange_rates(store.read("bronze", "exchange_rates")).quarantine.collect()
    assert {r["quote_currency"] for r in bad} == {"GBP", "CHF"}


def test_jdbc_watermark_filter_is_pushed_to_the_database(spark):
    url = _derby_url()
    _seed_orders(spark, url, [(1, 1, dt.datetime(2026, 1, 1), 10)])
    df = wm.since(jdbc.jdbc_scan(spark, url, "ORDERS", DERBY), "ORDER_ID", "0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(ORDER_ID), *GreaterThan(ORDER_ID,0)]" in plan


def test_jdbc_partitioned_read(spark):
    url = _derby_url()
    _seed_orders(spark, url, [(i, 1, dt.datetime(2026, 1, 1), 1) for i in range(1, 41)])
    df = jdbc.jdbc_scan(spark, url, "ORDERS", DERBY, partition_column="ORDER_ID",
                        lower_bound=1, upper_bound=41, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40


def _write_csv(text):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    p = os.path.join(d, "data.csv")
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_csv_fx_incremental_by_rate_date(spark, store):
    p = _write_csv("rate_date,base_currency,quote_currency,rate\n2024-01-01,USD,EUR,0.92\n2024-01-02,USD,EUR,0.93\n")
    spec = SourceSpec("exchange_rates", "fx-csv", lambda s: files.exchange_rates_csv(s, p), watermark_col="rate_date")
    assert extract(spark, store, spec, batch_id="b1").watermark_after == "2024-01-02"
    with open(p, "a") as fh:
        fh.write("2024-01-03,USD,EUR,0.94\n")
    r2 = extract(spark, store, spec, batch_id="b2")
    assert (r2.rows, r2.watermark_after) == (1, "2024-01-03")
    assert store.read("bronze", "exchange_rates").count() == 3


def test_csv_products_full_refresh_and_flag_parsing(spark, store):
    p = _write_csv(
        "product_id,product_name,category,subcategory,brand,unit_cost,list_price,is_active\n"
        "1,a,c,s,b,1.00,2.00,1\n2,b,c,s,b,1.00,2.00,0\n3,c,c,s,b,1.00,2.00,true\n"
    )
    spec = SourceSpec("products", "products-csv", lambda s: files.products_csv(s, p))
    assert extract(spark, store, spec).rows == 3
    assert extract(spark, store, spec).rows == 3
    got = {r["product_id"]: r["is_active"] for r in store.read("bronze", "products").collect()}
    assert got == {1: True, 2: False, 3: True}


def test_first_run_with_no_rows_leaves_no_table(spark, store):
    spec = SourceSpec("customers", "empty", lambda s: s.createDataFrame([], "customer_id INT"), watermark_col="customer_id")
    r = extract(spark, store, spec)
    assert r.rows == 0 and r.watermark_after is None
    assert not store.exists("bronze", "customers")


def test_overlap_rereads_but_never_moves_watermark_back(spark, store):
    rows = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 5))]
    df = lambda s: s.createDataFrame(rows, "id INT, d DATE")
    spec = SourceSpec("t", "src", df, watermark_col="d", overlap="2 days")
    extract(spark, store, spec, batch_id="b1")
    r = extract(spark, store, spec, batch_id="b2")
    assert r.rows == 1 and r.watermark_after == "2024-01-05"
    assert store.read("bronze", "t").where(F.col("id") == 2).count() == 2  # D1 in silver drops it


def _scattered(rows):
    def read(s):
        return s.createDataFrame([(i, f"r{i}") for i in rows], "id INT, x STRING").repartition(5, "id")

    return SourceSpec("t", "numbers", read, watermark_col="id")


def _files(store, batch):
    import glob

    return len(glob.glob(f"{store.table_path('bronze', 't')}/*/_batch_id={batch}/*.parquet"))


def _by_batch(store):
    return sorted((r["_batch_id"], r["id"], r["x"], str(r["_bronze_ingested_date"])) for r in store.read("bronze", "t").collect())


def test_small_files_are_merged_and_batches_stay(spark, store):
    extract(spark, store, _scattered(range(40)), run_ts=dt.datetime(2026, 1, 1), batch_id="0001")
    extract(spark, store, _scattered(range(70)), run_ts=dt.datetime(2026, 1, 2), batch_id="0002")
    extract(spark, store, _numbers_and_text([70]), run_ts=dt.datetime(2026, 1, 2), batch_id="0003")
    before = _by_batch(store)
    assert _files(store, "0001") > 1 and _files(store, "0002") > 1 and _files(store, "0003") == 1
    assert store.compact("bronze", "t") == 2  # the third is one file already
    assert _files(store, "0001") == _files(store, "0002") == 1 and _by_batch(store) == before
    assert store.compact("bronze", "t") == 0
    extract(spark, store, _scattered(range(71)), run_ts=dt.datetime(2026, 1, 9), batch_id="0002")
    assert _by_batch(store) == before
    assert extract(spark, store, _scattered(range(72)), batch_id="0004").rows == 1


def _numbers_and_text(rows):
    return SourceSpec("t", "numbers", lambda s: s.createDataFrame([(i, f"r{i}") for i in rows], "id INT, x STRING").coalesce(1), watermark_col="id")


@pytest.mark.parametrize("moves", [0, 1])
def test_a_compaction_that_dies_loses_and_doubles_nothing(spark, store, monkeypatch, moves):
    """It dies before its first or its second partition is in place: readers
    miss nothing, and the next write finishes it."""
    for batch, upto in (("a", 20), ("b", 40)):
        extract(spark, store, _scattered(range(upto)), run_ts=dt.datetime(2026, 1, 1), batch_id=batch)
    before, move, done = _by_batch(store), store._move, []

    def limited(source, target):
        if len(done) == moves:
            raise RuntimeError("lost")
        done.append(target)
        move(source, target)

    with monkeypatch.context() as m:
        m.setattr(store, "_move", limited)
        with pytest.raises(RuntimeError):
            store.compact("bronze", "t")
    assert _by_batch(store) == before
    extract(spark, store, _scattered(range(20)), run_ts=dt.datetime(2026, 1, 1), batch_id="a")
    assert _by_batch(store) == before and not [c for c in store._children(store.table_path("bronze", "t")) if "compacted" in c]


def test_a_compaction_that_dies_while_writing_is_forgotten(spark, store):
    extract(spark, store, _scattered(range(20)), batch_id="a")
    before = _by_batch(store)
    store.read("bronze", "t").write.partitionBy("_bronze_ingested_date", "_batch_id").parquet(f"{store.table_path('bronze', 't')}/_compacted-x")
    store._delete(f"{store.table_path('bronze', 't')}/_compacted-x/_SUCCESS")
    assert _by_batch(store) == before
    assert store.compact("bronze", "t") == 1 and _by_batch(store) == before
    assert store.compact("bronze", "none") == 0
