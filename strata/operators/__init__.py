"""Relational building blocks (pure DataFrame -> DataFrame)."""
from strata.operators.audit import add_audit_columns, add_ingested_date
from strata.operators.dedupe import dedupe_latest
from strata.operators.enrich import attach, flag_known, fx_to_usd
from strata.operators.quality import DQCheck, apply_dq_checks, flag_dq, split_flagged

__all__ = [
    "DQCheck",
    "add_audit_columns",
    "add_ingested_date",
    "apply_dq_checks",
    "attach",
    "dedupe_latest",
    "flag_dq",
    "flag_known",
    "fx_to_usd",
    "split_flagged",
]
