import os
import tempfile

from strata.sources.files import FX_SCHEMA
from strata.streaming import ingest_landed_files


def _land(d, name, lines):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("rate_date,base_currency,quote_currency,rate\n" + "".join(lines))


def test_landed_files_are_ingested_exactly_once(spark, store):
    landing = tempfile.mkdtemp(prefix="strata-landing-")
    _land(landing, "f1.csv", ["2024-01-01,USD,EUR,0.92\n", "2024-01-01,USD,GBP,0.79\n"])
    r1 = ingest_landed_files(spark, store, "exchange_rates", "fx-drop", landing, FX_SCHEMA)
    assert r1.rows == 2
    _land(landing, "f2.csv", ["2024-01-02,USD,EUR,0.93\n"])
    r2 = ingest_landed_files(spark, store, "exchange_rates", "fx-drop", landing, FX_SCHEMA)
    assert r2.rows == 1
    r3 = ingest_landed_files(spark, store, "exchange_rates", "fx-drop", landing, FX_SCHEMA)
    assert r3.rows == 0
    bronze = store.read("bronze", "exchange_rates")
    assert bronze.count() == 3
    assert {"_bronze_ingested_at", "_bronze_source", "_batch_id"} <= set(bronze.columns)


def test_counts_cover_all_batches(spark, store):
    landing = tempfile.mkdtemp(prefix="strata-landing-")
    for i in range(5):
        _land(landing, f"f{i}.csv", [f"2024-01-0{i + 1},USD,EUR,0.92\n"])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        r = ingest_landed_files(spark, store, "exchange_rates", "fx-drop", landing, FX_SCHEMA, max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (r.rows, r.batches) == (5, 5) and store.read("bronze", "exchange_rates").count() == 5


def test_two_streams_into_one_table_keep_their_rows(spark, store):
    for name, quote in (("one", "EUR"), ("two", "GBP"), ("two-lost", "CHF")):
        landing = tempfile.mkdtemp(prefix="strata-landing-")
        _land(landing, "f.csv", [f"2024-01-01,USD,{quote},0.92\n"])
        r = ingest_landed_files(spark, store, "exchange_rates", "fx", landing, FX_SCHEMA, checkpoint=f"{store.root}/_streams/{name}")
        assert r.rows == 1
    assert store.read("bronze", "exchange_rates").count() == 3
