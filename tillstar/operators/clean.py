"""Cleaning of raw order lines: trim, type, drop, fill, deduplicate, filter.

NULL stays NULL while trimming, so that missing critical values drop a row and
other missing values get their default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions import dates, numbers, text
from tillstar.operators.dedup import remove_duplicates

# Fields a row cannot do without, and the defaults of the others.
CRITICAL = ("Order ID", "Customer ID", "Product ID", "Sales", "Quantity", "Profit")
DEFAULTS = {
    "Postal Code": "Unknown",
    "Customer Name": "Unknown Customer",
    "Segment": "Consumer",
    "Country": "United States",
    "City": "Unknown City",
    "State": "Unknown State",
    "Region": "Unknown Region",
    "Sub-Category": "Unknown Sub-Category",
}


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def trim_whitespace(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: text.strip(F.col(f"`{c}`")) for c in texts}) if texts else df


def fix_data_types(df: DataFrame, date_formats: tuple[str, ...] = (dates.ISO,)) -> DataFrame:
    """Type amounts, dates and postal codes; unreadable values become NULL."""
    typed = {}
    for c in _present(df, ("Sales", "Profit")):
        typed[c] = F.col(c).try_cast("decimal(12,2)")
    for c in _present(df, ("Discount",)):
        typed[c] = F.col(c).try_cast("decimal(5,2)")
    for c in _present(df, ("Quantity",)):
        typed[c] = numbers.numeric(F.col(c)).try_cast("int")
    for c in _present(df, ("Order Date", "Ship Date")):
        is_text = isinstance(df.schema[c].dataType, T.StringType)
        typed[c] = dates.parse_date(F.col(c), date_formats) if is_text else F.to_date(c)
    for c in _present(df, ("Postal Code",)):
        typed[c] = text.postal_code(F.col(c).cast("string"))
    return df.withColumns(typed) if typed else df


def handle_missing_values(df: DataFrame, critical: Sequence[str] = CRITICAL,
                          defaults: dict[str, str] | None = None) -> DataFrame:
    defaults = DEFAULTS if defaults is None else defaults
    kept = df.na.drop(subset=_present(df, critical)) if _present(df, critical) else df
    fills = {c: v for c, v in defaults.items() if c in df.columns}
    return kept.na.fill(fills) if fills else kept


def remove_invalid_records(df: DataFrame) -> DataFrame:
    """Positive quantity, discount within [0, 1], shipped no earlier than ordered."""
    if "Quantity" in df.columns:
        df = df.filter(F.col("Quantity") > 0)
    if "Discount" in df.columns:
        df = df.filter(F.col("Discount").between(0, 1))
    if "Order Date" in df.columns and "Ship Date" in df.columns:
        df = df.filter(F.col("Order Date") <= F.col("Ship Date"))
    return df


def clean(df: DataFrame, date_formats: tuple[str, ...] = (dates.ISO,)) -> DataFrame:
    typed = fix_data_types(trim_whitespace(df), date_formats)
    return remove_invalid_records(remove_duplicates(handle_missing_values(typed)))
