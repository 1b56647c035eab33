"""Rates, means and scaling on exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from reliq.schemas import MONEY, RATE


def mean_money(total: Column, rows: Column) -> Column:
    """Mean in cents, halves away from zero; null without rows."""
    return F.round(total / F.nullif(rows, F.lit(0)).cast("decimal(20,0)"), 2).cast(MONEY)


def rate(part: Column, whole: Column) -> Column:
    """Share rounded to four digits; null when the whole is zero."""
    share = part.cast("decimal(20,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(share, 4).cast(RATE)


def guarded_rate(part: Column, whole: Column) -> Column:
    """Share with the whole taken as at least one."""
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def millionth(amount: Column) -> Column:
    """The exact amount divided by a million."""
    return (amount.cast("decimal(28,2)") * F.lit(Decimal("0.000001"))).cast("decimal(28,8)")


def four_digits(share: Column) -> Column:
    """Text with four decimals and no thousands separator."""
    return F.format_string("%.4f", share.cast("double"))
