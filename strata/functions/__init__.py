"""Column-level helpers built only from ``pyspark.sql.functions``."""
from strata.functions.money import (
    avg_money,
    cents,
    half_up_ratio_pct,
    money_from_cents,
)

__all__ = ["avg_money", "cents", "half_up_ratio_pct", "money_from_cents"]
