"""Q4-Q6: quarantine-rate gate between silver and gold.

``pct = round(quarantined / (good + quarantined) * 100, 2)`` (0 for an
empty table), computed exactly half-up from integer counts; a table
fails when ``pct > threshold`` -- i.e. the *rounded* rate is compared, as
in the reference.  All failures are reported together.

Error policy (Q6) without parsing error messages: a missing silver table
is a hard error; a missing quarantine table counts as 0 quarantined rows.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.money import half_up_ratio_pct
from strata.plans.checks import GATE_THRESHOLDS_PCT
from strata.sources.store import TableNotFound, TableStore

REPORT_COLUMNS = ["table", "good", "quarantined", "quarantine_pct", "threshold_pct", "passed"]


class GateFailed(RuntimeError):
    def __init__(self, violations: list[str]):
        super().__init__("gold blocked, quarantine rate above threshold for: " + "; ".join(violations))
        self.violations = violations


def _threshold(thresholds: Mapping[str, float]) -> Column:
    pairs = []
    for table, pct in thresholds.items():
        pairs += [F.lit(table), F.lit(float(pct))]
    return F.create_map(*pairs)[F.col("table")]


def gate_report(counts: DataFrame, thresholds: Mapping[str, float] = GATE_THRESHOLDS_PCT) -> DataFrame:
    """``counts(table, good, quarantined)`` -> the gate report."""
    total = F.col("good") + F.col("quarantined")
    pct = F.coalesce(half_up_ratio_pct(F.col("quarantined"), total), F.lit(0.0))
    return (
        counts.select(
            "table",
            F.col("good").cast("bigint").alias("good"),
            F.col("quarantined").cast("bigint").alias("quarantined"),
        )
        .withColumn("quarantine_pct", pct)
        .withColumn("threshold_pct", _threshold(thresholds))
        .withColumn("passed", F.col("quarantine_pct") <= F.col("threshold_pct"))
        .select(*REPORT_COLUMNS)
    )


def store_counts(store: TableStore, tables: list[str]) -> DataFrame:
    """One union of per-table counts, evaluated as a single job."""
    parts = []
    for t in tables:
        try:
            good = store.read("silver", t)
        except TableNotFound as e:
            raise RuntimeError(f"silver.{t} is missing; refusing to treat it as empty") from e
        g = good.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(t).alias("table"), F.col("n").alias("good"), F.lit(0).cast("bigint").alias("quarantined")
        )
        parts.append(g)
        if store.exists("quarantine", t):
            q = store.read("quarantine", t).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(t).alias("table"), F.lit(0).cast("bigint").alias("good"), F.col("n").alias("quarantined")
            )
            parts.append(q)
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("table").agg(F.sum("good").alias("good"), F.sum("quarantined").alias("quarantined"))


def check_gate(report: DataFrame) -> list[dict]:
    """Collect the (one row per table) report and raise on any failure."""
    rows = [r.asDict() for r in report.orderBy("table").collect()]
    violations = [
        f"{r['table']}: {r['quarantine_pct']:.2f}% quarantined (threshold {r['threshold_pct']}%)"
        for r in rows
        if not r["passed"]
    ]
    if violations:
        raise GateFailed(violations)
    return rows


def counts_frame(spark, counts: Mapping[str, tuple[int, int]]) -> DataFrame:
    """(table, good, quarantined) from counts already known on the driver
    (one row per table, built in the JVM)."""
    rows = [
        F.struct(
            F.lit(t).alias("table"),
            F.lit(int(g)).cast("bigint").alias("good"),
            F.lit(int(q)).cast("bigint").alias("quarantined"),
        )
        for t, (g, q) in counts.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dq_gate_observed(
    spark, counts: Mapping[str, tuple[int, int]], thresholds: Mapping[str, float] = GATE_THRESHOLDS_PCT
) -> list[dict]:
    """The gate on the counts observed while the silver tables were
    written in this run (exact, and no re-scan of ten tables)."""
    missing = [t for t in thresholds if t not in counts]
    if missing:
        raise RuntimeError(f"silver tables missing from this run: {missing}")
    return check_gate(gate_report(counts_frame(spark, {t: counts[t] for t in thresholds}), thresholds))


def dq_gate(store: TableStore, thresholds: Mapping[str, float] = GATE_THRESHOLDS_PCT) -> list[dict]:
    return check_gate(gate_report(store_counts(store, list(thresholds)), thresholds))
