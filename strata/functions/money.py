"""Exact money arithmetic.

Amounts in silver are doubles already rounded to cents.  Summing doubles
depends on addition order, which Spark does not fix across partitions, so
``round(avg(x), 2)`` can flip a half-cent tie from run to run.  Every
aggregate here works on whole cents (``bigint``), which is associative
and therefore identical for any partitioning, and rounds half-up exactly.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: Column | str) -> Column:
    """A cent-rounded double amount as whole cents (bigint)."""
    return F.round(_c(col) * 100).cast("bigint")


def money_from_cents(cents_col: Column | str) -> Column:
    """Whole cents back to a double amount."""
    return _c(cents_col) / F.lit(100)


def _div(num: Column, den: Column) -> Column:
    """Exact integral division (SQL ``div``) on decimal(38,0) operands."""
    return F.call_function(
        "div", num.cast("decimal(38,0)"), den.cast("decimal(38,0)")
    )


def avg_money(total_cents: Column | str, n: Column | str) -> Column:
    """Exact half-up average of cent amounts, as a double amount.

    ``(2s + n) div 2n`` is ``s / n`` rounded half-up for ``s >= 0``
    (money sums are non-negative: ``order_total >= 0`` is a check).
    NULL when ``n`` is 0 or NULL.
    """
    s, cnt = _c(total_cents), _c(n)
    return F.when(cnt > 0, _div(s.cast("decimal(38,0)") * 2 + cnt, cnt * 2) / F.lit(100))


def half_up_ratio_pct(num_cents: Column | str, den_cents: Column | str) -> Column:
    """``round(num / den * 100, 2)`` computed exactly, half-up, for
    non-negative integer operands.  NULL when ``den`` is not positive."""
    num, den = _c(num_cents), _c(den_cents)
    hundredths = _div(num.cast("decimal(38,0)") * 20000 + den, den * 2)
    return F.when(den > 0, hundredths / F.lit(100))


def growth_pct(before_cents: Column | str, now_cents: Column | str) -> Column:
    """``round((now - before) / before * 100, 2)`` computed exactly, half
    away from zero, for integers; NULL when ``before`` is 0 or NULL."""
    before, now = (_c(c).cast("decimal(38,0)") for c in (before_cents, now_cents))
    size = _div(F.abs(now - before) * 20000 + F.abs(before), F.abs(before) * 2)
    sign = F.when((now >= before) == (before > 0), 1).otherwise(-1)
    return F.when(before != 0, size * sign / F.lit(100))
