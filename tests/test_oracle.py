"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from strata.oracle import oracle_sql as library_sql
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "benchmark", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "as_tuple"):
        return str(v)
    return None if v is None else repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_every_query_of_the_library_has_an_oracle():
    from strata.queries import QUERIES

    assert set(QUERIES) == set(library_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_revenue_usd" in df.columns


@pytest.mark.parametrize(
    "name", ["incremental_orders", "bronze_append_history", "watermark_latest", "dedupe_fx_composite", "gold_monthly_revenue"]
)
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
