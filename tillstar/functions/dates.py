"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"
# The accepted spellings of a date, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd-MM-yyyy")


def parse_date(text: Column, formats: tuple[str, ...] = (ISO,)) -> Column:
    """First format that fits, else NULL."""
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def date_key(date: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def date_key_from_text(text: Column, strict: bool = True) -> Column:
    """``YYYYMMDD`` of a text in any accepted format; unreadable text fails if ``strict``."""
    trimmed = F.trim(text)
    key = date_key(parse_date(trimmed, DATE_FORMATS))
    if not strict:
        return key
    error = F.raise_error(F.concat(F.lit("not a date: "), trimmed)).cast("int")
    return F.when(key.isNotNull() | trimmed.isNull(), key).otherwise(error)


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def iso_day_of_week(date: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(date) + 1


def fiscal_quarter(date: Column) -> Column:
    """Quarter of a year that starts in April."""
    return (F.floor(F.pmod(F.month(date) - 4, F.lit(12)) / 3) + 1).cast("int")


def fiscal_year(date: Column) -> Column:
    """Calendar year in which the fiscal year began."""
    return F.when(F.month(date) >= 4, F.year(date)).otherwise(F.year(date) - 1)


def format_date(day: Column) -> Column:
    """``2024-05-01``, as dates are shown; NULL stays NULL."""
    return F.date_format(day, "yyyy-MM-dd")
