"""Data sets of the report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.numbers import ratio, safe_divide
from tillstar.plans.analytics import margin, with_month_name
from tillstar.plans.star import Star


def _split(star: Star, keys: Sequence[str], measures: Sequence[str] = ("revenue", "profit")) -> DataFrame:
    return star.order_totals(keys, measures).groupBy(*keys).agg(*[F.sum(m).alias(f"total_{m}") for m in measures])


def place_matrix(star: Star) -> DataFrame:
    """Region, state and city with subtotals; ``level`` 0 is a city, 7 the grand total."""
    keys = ("region", "state", "city")
    totals = star.order_totals((*keys, "full_date"), ("revenue", "profit", "ship_day")).withColumn(
        "waited", F.col("ship_day") - F.col("line_count") * F.unix_date("full_date"))
    sums = ("revenue", "profit", "line_count", "waited")
    if star.order_fixes(*keys, "full_date"):
        cities = totals.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in sums], F.count(F.lit(1)).alias("orders"))
        counted, rows = F.sum("orders"), cities
    else:
        counted, rows = F.count_distinct("order_id"), totals
    return rows.rollup(*keys).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"), counted.alias("total_orders"),
        safe_divide(F.sum("waited"), F.sum("line_count")).alias("average_shipping_days"))


def year_matrix(star: Star, years: Sequence[int]) -> DataFrame:
    """Quarter and month rows, one revenue and one growth column per year."""
    months = star.order_totals(("year", "quarter", "month"), ("revenue",)).groupBy("year", "quarter", "month").agg(
        F.sum("revenue").alias("revenue"))
    earlier = months.select((F.col("year") + 1).alias("year"), "month", F.col("revenue").alias("_earlier"))
    grown = months.join(earlier, ["year", "month"], "left").withColumn(
        "growth", safe_divide(F.col("revenue") - F.col("_earlier"), F.col("_earlier")))
    matrix = grown.groupBy("quarter", "month").pivot("year", list(years)).agg(
        F.sum("revenue").alias("revenue"), F.sum("growth").alias("growth"))
    return matrix.select("quarter", "month", *[
        F.col(f"`{y}_{m}`").alias(f"{m}_{y}") for y in years for m in ("revenue", "growth")])


def weekday_volume(star: Star) -> DataFrame:
    days = star.order_totals(("full_date",), ("revenue", "quantity")).groupBy(
        (F.weekday("full_date") + 1).alias("day_of_week"), F.date_format("full_date", "EEEE").alias("day_name"))
    return days.agg(F.sum("revenue").alias("total_revenue"), F.sum("quantity").alias("total_quantity"),
                    F.count(F.lit(1)).alias("total_orders"))


def segment_contribution(star: Star) -> DataFrame:
    """Revenue of each segment and its share of the whole."""
    segments = _split(star, ("segment",), ("revenue",))
    whole = segments.agg(F.sum("total_revenue")).scalar()
    return segments.withColumn("revenue_share", safe_divide(F.col("total_revenue"), whole))


def segment_trend(star: Star) -> DataFrame:
    return _split(star, ("segment", "year", "month"))


def discount_scatter(star: Star) -> DataFrame:
    """Per product: mean discount, margin, revenue and units."""
    keys = ("product_id", "product_name")
    totals = star.totals(keys, ("discount", "revenue", "profit", "quantity")).withColumnsRenamed(
        {m: f"total_{m}" for m in ("revenue", "profit", "quantity")})
    return totals.select(
        *keys, ratio(F.col("discount"), F.col("line_count"), 4).alias("average_discount"), "total_revenue",
        "total_quantity", margin().alias("profit_margin"))


def place_map(star: Star) -> DataFrame:
    return _split(star, ("city", "state")).withColumn("profit_margin", margin())


def monthly_trend(star: Star) -> DataFrame:
    return with_month_name(_split(star, ("year", "month")))


def category_split(star: Star) -> DataFrame:
    return star.totals(("category_name",), ("revenue", "profit")).withColumnsRenamed(
        {"revenue": "total_revenue", "profit": "total_profit"}).drop("line_count")


def region_split(star: Star) -> DataFrame:
    return _split(star, ("region",))


def top_states(star: Star, by: str = "profit_margin", limit: int = 10) -> DataFrame:
    states = _split(star, ("state",)).withColumn("profit_margin", margin())
    return states.orderBy(F.desc(by), "state").limit(limit)


def top_customer_values(star: Star, limit: int = 50) -> DataFrame:
    """The customers of most lifetime value with orders and margin."""
    keys = ("customer_id", "customer_name")
    return star.order_totals(keys, ("revenue", "profit")).groupBy(*keys).agg(
        F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"),
        F.count(F.lit(1)).alias("total_orders"),
    ).withColumn("profit_margin", margin()).drop("total_profit").orderBy(F.desc("total_revenue"), "customer_id").limit(limit)
