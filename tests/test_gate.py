import pytest

from strata.plans import gate, validate
from strata.plans.gate import GateFailed


def report(spark, rows, thresholds=None):
    counts = spark.createDataFrame(rows, "table STRING, good BIGINT, quarantined BIGINT")
    return {r["table"]: r.asDict() for r in gate.gate_report(counts, thresholds or gate.GATE_THRESHOLDS_PCT).collect()}


def test_exactly_at_threshold_passes_just_above_fails(spark):
    got = report(spark, [("orders", 99, 1), ("order_items", 9899, 101)])
    assert (got["orders"]["quarantine_pct"], got["orders"]["passed"]) == (1.0, True)
    assert (got["order_items"]["quarantine_pct"], got["order_items"]["passed"]) == (1.01, False)


def test_rounded_rate_is_compared(spark):
    # 1.004% rounds to 1.0 and passes, as in the reference.
    got = report(spark, [("orders", 98996, 1004)])
    assert got["orders"]["quarantine_pct"] == 1.0 and got["orders"]["passed"]


def test_empty_table_passes(spark):
    got = report(spark, [("exchange_rates", 0, 0)])
    assert (got["exchange_rates"]["quarantine_pct"], got["exchange_rates"]["passed"]) == (0.0, True)


def test_gate_on_store(spark, store):
    good = spark.range(99).selectExpr("id AS order_id")
    store.replace("silver", "orders", good)
    assert gate.dq_gate(store, {"orders": 1.0})[0]["quarantined"] == 0  # missing quarantine = 0
    store.replace("quarantine", "orders", spark.range(2).selectExpr("id AS order_id"))
    with pytest.raises(GateFailed) as e:
        gate.dq_gate(store, {"orders": 1.0})
    assert "orders: 1.98%" in str(e.value)
    # A clean later run rewrites the quarantine (also when empty) and passes.
    store.replace("quarantine", "orders", spark.range(0).selectExpr("id AS order_id"))
    assert gate.dq_gate(store, {"orders": 1.0})[0]["passed"]


def test_missing_silver_is_a_hard_error(store):
    with pytest.raises(RuntimeError, match="silver.products is missing"):
        gate.dq_gate(store, {"products": 3.0})


def test_validation_reports_every_problem(spark, store):
    store.replace("gold", "daily_sales", spark.range(3))
    store.replace("gold", "customer_360", spark.range(0))
    with pytest.raises(validate.ValidationFailed) as e:
        validate.validate_outputs(store, ["daily_sales", "customer_360", "monthly_revenue"])
    msg = str(e.value)
    assert "customer_360: 0 rows" in msg and "monthly_revenue: missing" in msg and "daily_sales" not in msg


def test_empty_rebuild_reads_back_with_its_schema(spark, store):
    df = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS s", "'2026-01' AS m").where("id < 0")
    store.replace("silver", "t", df, partition_by=["m"])
    back = store.read("silver", "t")
    assert back.count() == 0 and back.columns == ["id", "s", "m"]


def test_failed_rebuild_is_invisible_and_cleaned_up(spark, store):
    import os

    store.replace("gold", "m", spark.range(3))
    base = store.table_path("gold", "m")
    # a crashed attempt: a version directory without the commit marker
    os.makedirs(os.path.join(base, "_v=000000000000001-deadbeef"))
    assert store.read("gold", "m").count() == 3
    store.replace("gold", "m", spark.range(5))
    assert store.read("gold", "m").count() == 5
    assert "_v=000000000000001-deadbeef" not in os.listdir(base)
    assert len([c for c in os.listdir(base) if c.startswith("_v=")]) == 2


def test_gate_on_observed_counts_matches_store_counts(spark, store):
    store.replace("silver", "orders", spark.range(99).selectExpr("id AS order_id"))
    store.replace("quarantine", "orders", spark.range(2).selectExpr("id AS order_id"))
    with pytest.raises(GateFailed) as a:
        gate.dq_gate(store, {"orders": 1.0})
    with pytest.raises(GateFailed) as b:
        gate.dq_gate_observed(spark, {"orders": (99, 2)}, {"orders": 1.0})
    assert str(a.value) == str(b.value)
    assert gate.dq_gate_observed(spark, {"orders": (99, 1)}, {"orders": 1.0})[0]["passed"]
