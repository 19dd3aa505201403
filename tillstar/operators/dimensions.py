"""Building and extending the dimensions from a batch of prepared order lines.

Every ``new_*`` function returns only the rows to append, with surrogate keys that
follow the existing ones in the order of the natural keys. A second run with the
same batch therefore returns nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import dates, text
from tillstar.operators.dedup import first_per_key, row_order
from tillstar.operators.ranking import with_row_number
from tillstar.schemas import DIM_CATEGORY, DIM_DATE, DIM_PRODUCT, DIM_REGION


def assign_keys(rows: DataFrame, key: str, natural: Sequence[str], existing: DataFrame) -> DataFrame:
    """Number ``rows`` by ``natural`` after the largest ``key`` of ``existing``."""
    largest = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("largest")).first().largest
    numbered = with_row_number(rows, natural, "_number")
    return numbered.withColumn(key, F.col("_number") + F.lit(int(largest))).drop("_number")


def _stamped(rows: DataFrame, schema) -> DataFrame:
    now = F.current_timestamp()
    return rows.withColumns({"created_at": now, "updated_at": now}).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def calendar_columns(day: Column) -> list[Column]:
    """The fifteen calendar columns of a date."""
    parts = {
        "date_key": dates.date_key(day), "full_date": day, "day_of_week": dates.iso_day_of_week(day),
        "day_name": dates.day_name(day), "day_of_month": F.dayofmonth(day), "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day), "month": F.month(day), "month_name": dates.month_name(day),
        "quarter": F.quarter(day), "year": F.year(day), "is_weekend": F.weekday(day) >= 5,
        "is_holiday": F.lit(False), "fiscal_quarter": dates.fiscal_quarter(day), "fiscal_year": dates.fiscal_year(day),
    }
    return [parts[f.name].cast(f.dataType).alias(f.name) for f in DIM_DATE.fields]


def calendar(batch: DataFrame, *date_columns: str) -> DataFrame:
    """All days of the calendar years that the dates of ``batch`` touch.

    Nothing comes out unless every date column has a value.
    """
    ends = batch.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in date_columns for f in (F.min, F.max)])
    low = F.least(*[F.col(f"`min_{c}`") for c in date_columns])
    high = F.greatest(*[F.col(f"`max_{c}`") for c in date_columns])
    for c in date_columns:
        ends = ends.filter(F.col(f"`min_{c}`").isNotNull())
    first, last = F.make_date(F.year(low), F.lit(1), F.lit(1)), F.make_date(F.year(high), F.lit(12), F.lit(31))
    days = ends.select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def new_dates(existing: DataFrame, batch: DataFrame) -> DataFrame:
    return calendar(batch, "Order Date", "Ship Date").join(existing, "date_key", "left_anti")


def new_categories(existing: DataFrame, batch: DataFrame) -> DataFrame:
    pairs = batch.select(F.col("Category").alias("category_name"), F.col("Sub-Category").alias("sub_category"))
    names = ("category_name", "sub_category")
    unseen = pairs.na.drop().distinct().join(existing, list(names), "left_anti")
    rows = unseen.withColumns({
        "category_id": text.category_code(F.col("category_name"), F.col("sub_category")),
        "description": text.category_description(F.col("category_name"), F.col("sub_category")),
    })
    return _stamped(assign_keys(rows, "category_key", names, existing), DIM_CATEGORY)


PLACE = ("country", "state", "city", "postal_code")


def new_regions(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """New places; the region label of the first row of a place wins."""
    code = F.element_at(F.split(F.col("Postal Code").cast("string"), r"\."), 1)
    named = batch.na.drop(subset=["Country", "State", "City"])
    own = ["Row ID"] if "Row ID" in batch.columns else [c for c in batch.columns if c not in ("Country", "State", "City", "Region")]
    rows = named.select("Country", "State", "City", "Region", F.coalesce(code, F.lit("Unknown")).alias("_code"), *[F.col(f"`{c}`") for c in own])
    first = first_per_key(rows, ("Country", "State", "City", "_code"), row_order(batch), combine=True).select(
        F.col("Country").alias("country"), F.col("State").alias("state"), F.col("City").alias("city"),
        F.col("_code").alias("postal_code"), F.col("Region").alias("region"))
    known = existing.select("country", "state", "city", F.coalesce("postal_code", F.lit("Unknown")).alias("postal_code"))
    unseen = first.join(known, list(PLACE), "left_anti")
    return _stamped(assign_keys(unseen, "region_key", PLACE, existing), DIM_REGION)


def new_products(existing: DataFrame, batch: DataFrame, categories: DataFrame, name_length: int | None = None) -> DataFrame:
    """New products from their first row; the category is NULL if unknown.

    Names are kept whole; ``name_length`` cuts them for a target with a limited column.
    """
    name = F.col("Product Name") if name_length is None else F.left(F.col("Product Name"), F.lit(name_length))
    rows = batch.na.drop(subset=["Product ID", "Product Name"])
    first = first_per_key(rows, ("Product ID",), row_order(rows)).select(
        F.col("Product ID").alias("product_id"), name.alias("product_name"),
        F.col("Category").alias("category_name"), F.col("Sub-Category").alias("sub_category"))
    unseen = first.join(existing, "product_id", "left_anti")
    keyed = unseen.join(categories.select("category_key", "category_name", "sub_category"),
                        ["category_name", "sub_category"], "left")
    return _stamped(assign_keys(keyed, "product_key", ("product_id",), existing), DIM_PRODUCT)
