"""Exact money arithmetic.

Money is summed as integer cents, which aggregate faster than decimals of the same
range, and leaves as decimal.  Ratios are formed and rounded as decimals, never as
doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

WIDE = "decimal(38,10)"
MONEY_TOTAL = "decimal(38,2)"


def total_cents(amount: str) -> Column:
    """Sum of a two-digit decimal column in cents; an overflow of 92 quadrillion raises."""
    return F.sum((F.col(amount) * 100).cast("long"))


def as_money(cents: Column) -> Column:
    return (cents.cast("decimal(35,0)") * F.lit(Decimal("0.01"))).cast(MONEY_TOTAL)


def wide_product(left: Column, right: Column) -> Column:
    """Product of two counts or cent totals, wide enough for a key that holds most rows of both sides."""
    return left.cast("decimal(19,0)") * right.cast("decimal(18,0)")


def exact_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half away from zero; NULL over nothing."""
    return F.round(numerator.cast(WIDE) / F.nullif(denominator, F.lit(0)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of ``whole`` in percent, NULL when there is no whole."""
    return exact_ratio(part.cast(WIDE) * 100, whole, digits)


def audit_percent(part: Column, whole: Column) -> Column:
    """Like :func:`percent`, but an empty table counts as 0 percent."""
    return F.coalesce(percent(part, whole), F.lit(0)).cast("double")
