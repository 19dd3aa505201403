"""The read functions: lookups, pages of rows, and the dashboard data sets."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.plans import analytics
from tillstar.plans.star import Star



def page(df: DataFrame, sort: list[Column], number: int = 1, size: int = 20, largest: int = 100) -> DataFrame:
    """Rows of page ``number`` (from 1). ``sort`` should end in a unique column.

    A page of more than ``largest`` rows is refused. All rows up to the page's end meet in one task; deep pages
    are for :func:`page_after`.
    """
    if number < 1 or not 1 <= size <= largest:
        raise ValueError(f"page {number} of size {size}")
    return df.orderBy(*sort).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, last=None, size: int = 20) -> DataFrame:
    """The next rows by descending ``key`` after ``last``; as cheap for deep pages as for the first."""
    rest = df if last is None else df.filter(F.col(key) < last)
    return rest.orderBy(F.desc(key)).limit(size)


def page_count(total: int, size: int) -> int:
    return math.ceil(total / size) if total else 0


def page_info(df: DataFrame, number: int = 1, size: int = 20) -> DataFrame:
    """One row: rows in all, and how many pages they fill."""
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(number).alias("page"), F.lit(size).alias("page_size"),
        F.ceil(F.col("total") / size).cast("bigint").alias("total_pages"))


def kpis(star: Star) -> DataFrame:
    """The headline card; its total sales are net of discounts."""
    return analytics.get_kpis(star).select(
        F.col("net_revenue").alias("total_sales"), "total_profit", "total_orders",
        F.col("average_order_value").alias("avg_order_value"), F.col("net_profit_margin").alias("profit_margin"),
        "total_customers")


def customers(star: Star, segment: str | None = None) -> DataFrame:
    """Current customer versions."""
    current = star.dimension("dim_customer").filter("is_current")
    return current if segment is None else current.filter(F.col("segment") == segment)


def customer(star: Star, customer_id: str) -> DataFrame:
    """The current version of one customer; no row if there is none."""
    return customers(star).filter(F.col("customer_id") == customer_id).limit(1)


def products(star: Star, category: str | None = None) -> DataFrame:
    """Products with their category, if they have one."""
    categories = star.dimension("dim_category").select("category_key", "category_name")
    joined = star.dimension("dim_product").join(categories, "category_key", "left").select(
        "product_key", "product_id", "product_name", "sub_category", "category_name")
    return joined if category is None else joined.filter(F.col("category_name") == category)


def product(star: Star, product_id: str) -> DataFrame:
    return products(star).filter(F.col("product_id") == product_id).limit(1)


_LINE = ("sales_key", "order_id", "sales", "quantity", "discount", "profit", "revenue", "profit_margin", "full_date",
         "ship_date", "customer_name", "product_name", "region", "category_name")


def sales_lines(star: Star, start: dt.date | None = None, end: dt.date | None = None, region: str | None = None,
                category: str | None = None, min_sales: float | None = None) -> DataFrame:
    """Order lines with the names of their dimensions."""
    where = analytics.in_period(start, end)
    if region is not None:
        where = where & (F.col("region") == region)
    if category is not None:
        where = where & (F.col("category_name") == category)
    if min_sales is not None:
        where = where & (F.col("sales") >= min_sales)
    lines = star.lines(*_LINE, "order_date_key", "order_year", where=where)
    return lines.withColumnsRenamed({"full_date": "order_date", "category_name": "category"}).drop("order_date_key", "order_year")


def dashboard(star: Star) -> dict[str, DataFrame]:
    """The five data sets of the dashboard."""
    by_category = analytics.profitability_analysis(star, "category").groupBy(F.col("category_name").alias("category")).agg(
        F.sum("total_revenue").alias("sales"), F.sum("total_profit").alias("profit"))
    by_region = analytics.regional_performance(star).groupBy("region").agg(
        F.sum("total_revenue").alias("sales"), F.sum("total_profit").alias("profit"))
    trend = analytics.sales_trends(star, "monthly").select(
        "year", "month", "month_name", F.col("total_revenue").alias("sales"), F.col("total_profit").alias("profit"),
        F.col("total_orders").alias("orders"))
    top = analytics.top_products(star, 5).select(
        "product_id", "product_name", F.col("category_name").alias("category"),
        F.col("total_revenue").alias("sales"), F.col("total_profit").alias("profit"))
    return {"kpis": kpis(star), "sales_by_category": by_category, "sales_by_region": by_region,
            "monthly_trend": trend, "top_products": top}
