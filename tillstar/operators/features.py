"""Canonical names and derived columns of cleaned order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import dates, text
from tillstar.operators.quantiles import detect_outliers

_NAMES = {"Category": text.category_name, "Sub-Category": text.place_name}
_PLACES = {"Region": text.region_name, "Country": text.country_name, "State": text.place_name, "City": text.place_name}


def _rename(df: DataFrame, rules: dict) -> DataFrame:
    changed = {c: rule(F.col(f"`{c}`")) for c, rule in rules.items() if c in df.columns}
    return df.withColumns(changed) if changed else df


def normalize_categories(df: DataFrame) -> DataFrame:
    return _rename(df, _NAMES)


def normalize_regions(df: DataFrame) -> DataFrame:
    return _rename(df, _PLACES)


def revenue(df: DataFrame):
    if "Discount" not in df.columns:
        return F.col("Sales")
    return (F.col("Sales") * (1 - F.col("Discount"))).cast("decimal(12,2)")


def profit_margin(df: DataFrame):
    """Profit over sales within [-10, 1], zero without sales."""
    if not {"Profit", "Sales"} <= set(df.columns):
        return F.lit(0).cast("decimal(6,4)")
    share = F.try_divide(F.col("Profit"), F.col("Sales"))
    clipped = F.greatest(F.lit(-10), F.least(F.lit(1), share))
    return F.when(F.col("Sales") > 0, clipped).otherwise(F.lit(0)).cast("decimal(6,4)")


def engineer_features(df: DataFrame) -> DataFrame:
    """Revenue, margin, days to ship and the parts of the order date."""
    has = set(df.columns)
    added = {"Revenue": revenue(df), "Profit_Margin": profit_margin(df)}
    if {"Order Date", "Ship Date"} <= has:
        added["Order_to_Ship_Days"] = F.datediff("Ship Date", "Order Date")
    else:
        added["Order_to_Ship_Days"] = F.lit(-1)
    if "Order Date" in has:
        day = F.col("Order Date")
        added |= {
            "Order_Year": F.year(day), "Order_Quarter": F.quarter(day), "Order_Month": F.month(day),
            "Order_Month_Name": dates.month_name(day), "Order_Day_of_Week": F.weekday(day),
            "Order_Day_Name": dates.day_name(day),
        }
    return df.withColumns(added)


def transform(df: DataFrame, exact: bool = True) -> DataFrame:
    """Names, outlier flag and derived columns. ``df`` is read once more for the bounds."""
    named = normalize_regions(normalize_categories(df))
    return engineer_features(detect_outliers(named, exact=exact))
