"""Exact money arithmetic: amounts net of VAT and rounded shares.

Nothing here goes through floating point: a price of 0.55 is a tie after the
division by 1.1 and a double lands on the wrong side of about half such ties.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: prices include 10% VAT.
VAT_DIVISOR = Decimal("1.1")


def money(df: DataFrame, name: str) -> Column:
    """Amount column in an exact type; floating amounts become two-decimal ones."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).cast("decimal(18,2)")
    return F.col(name)


def is_whole(df: DataFrame, *names: str) -> bool:
    """True if every column is of an integer type."""
    return all(isinstance(df.schema[name].dataType, T.IntegralType) for name in names)


def integer_div(dividend: Column, divisor: Column) -> Column:
    """Quotient cut toward zero, as bigint."""
    return F.call_function("div", dividend, divisor)


def vat_net(amount: Column, whole: bool) -> Column:
    """Amount net of VAT, rounded half away from zero, as bigint.

    For whole currency units the rounding is ``floor((20x + 11) / 22)``, plain
    64-bit arithmetic; other exact amounts use decimal division.
    """
    if whole:
        half = F.when(amount < 0, -11).otherwise(11)
        return integer_div(amount.cast("bigint") * 20 + half, F.lit(22))
    return F.round(amount / F.lit(VAT_DIVISOR), 0).cast("bigint")


def rounded_amount(amount: Column, whole: bool) -> Column:
    """Amount rounded to whole units, as bigint."""
    return amount.cast("bigint") if whole else F.round(amount, 0).cast("bigint")


def rounded_share(part: Column, total: Column, digits: int, percent: bool = False) -> Column:
    """``part / total`` rounded half away from zero; NULL for a zero total.

    Works in integers so that no intermediate scale can shift a tie.
    """
    part_units, total_units = (
        (amount.cast("decimal(26,2)") * 100).cast("decimal(28,0)") for amount in (part, total)
    )
    factor = 10**digits * (100 if percent else 1)
    doubled = F.abs(part_units) * (2 * factor) + F.abs(total_units)
    size = integer_div(doubled, F.nullif(F.abs(total_units) * 2, F.lit(0)))
    signed = F.when((part_units < 0) != (total_units < 0), -size).otherwise(size)
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast(T.DecimalType(20, digits))
