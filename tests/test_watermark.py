"""S7, K6, P7 over a made-up history of marks."""
import datetime as dt

import pytest

from strata.sources import watermark as wm

HISTORY = [  # (table, value, batch, hour)
    ("ledger", "17", "n1", 4), ("parcels", "2031-05-02 08:30:00", "n1", 4),
    ("ledger", "40", "n3", 9), ("ledger", "23", "n2", 6), ("parcels", "2031-05-01 00:00:00", "n0", 1),
]


@pytest.fixture
def history(store):
    for table, value, batch, hour in HISTORY:
        wm.set_watermark(store, table, value, "bigint", batch, dt.datetime(2031, 5, 3, hour))
    return store


def test_the_newest_entry_counts_whatever_order_they_came_in(history):
    want = {}
    for table, value, batch, hour in sorted(HISTORY, key=lambda h: h[3]):
        want[table] = (value, batch)
    assert {t: wm.current(history, t) for t in want} == want
    assert {r["source_table"]: r["watermark_value"] for r in wm.latest(history).collect()} == {t: v for t, (v, _) in want.items()}
    assert wm.log(history).count() == len(HISTORY)


def test_unknown_tables_have_no_mark(store, history):
    assert wm.current(history, "nowhere") == (None, None)
    assert wm.get_watermark(history, "nowhere") is None


def test_an_empty_store_has_no_mark_and_takes_no_empty_one(store):
    assert wm.get_watermark(store, "ledger") is None
    with pytest.raises(ValueError):
        wm.set_watermark(store, "ledger", None)


@pytest.mark.parametrize(
    "ddl,values,mark,past",
    [
        ("k SMALLINT", [9, 10, 100, None], "10", [100]),  # as numbers, not as text
        ("k DATE", [dt.date(2031, 1, 9), dt.date(2031, 1, 10)], "2031-01-09", [dt.date(2031, 1, 10)]),
        ("k TIMESTAMP", [dt.datetime(2031, 1, 9, 5), dt.datetime(2031, 1, 9, 6)], "2031-01-09 05:00:00", [dt.datetime(2031, 1, 9, 6)]),
    ],
)
def test_only_rows_past_the_mark_in_the_columns_own_type(spark, ddl, values, mark, past):
    rows = spark.createDataFrame([(v,) for v in values], ddl)
    assert [r["k"] for r in wm.since(rows, "k", mark).collect()] == past
    assert wm.since(rows, "k", None).count() == len(values)
