"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient rounded half away from zero, NULL on a zero denominator.

    Sums of sums carry a very wide decimal type, for which Spark would keep six
    digits of the quotient and round twice. These types keep fourteen.
    """
    quotient = F.try_divide(numerator.cast("decimal(24,4)"), denominator.cast("decimal(22,4)"))
    return F.round(quotient, digits)


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient as double, ``default`` where it is undefined."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(quotient, F.lit(float(default)))


def format_currency(value: Column, symbol: str = "$") -> Column:
    """``$1,234.50``; ``N/A`` for NULL, NaN and infinities."""
    x = value.cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(finite, F.concat(F.lit(symbol), F.format_number(x, 2))).otherwise(F.lit("N/A"))


def format_percent(value: Column, digits: int = 1) -> Column:
    """``12.3%`` from a fraction."""
    return F.concat(F.format_number(value.cast("double") * 100, digits), F.lit("%"))


def numeric(text: Column) -> Column:
    """Text to double; NULL for anything unreadable, NaN included."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def money(text: Column) -> Column:
    """Text to a two-digit decimal amount, NULL for anything unreadable."""
    return text.try_cast("decimal(12,2)")


