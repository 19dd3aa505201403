"""Window queries: moving averages, running totals, ranks and RFM segments.

Windows without a partition appear only over rows already grouped by day, month
or sub-category, whose number does not grow with the order lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numbers import ratio
from tillstar.operators.ranking import with_ntile, with_rank
from tillstar.plans.analytics import customer_totals, margin, order_value, product_totals, with_month_name
from tillstar.plans.star import Star
from tillstar.session import materialize


def moving_average(value: str, rows: int, order: tuple[str, ...]) -> Column:
    """Mean of the last ``rows`` rows, to two digits."""
    frame = Window.orderBy(*order).rowsBetween(1 - rows, 0)
    return ratio(F.sum(value).over(frame), F.count(value).over(frame), 2)


def running_total(value: str, order: tuple[str, ...], restart: tuple[Column, ...] = ()) -> Column:
    frame = Window.partitionBy(*restart).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(frame)


def daily_totals(star: Star) -> DataFrame:
    return star.order_totals(("full_date",), ("revenue", "profit")).groupBy("full_date").agg(
        F.sum("revenue").alias("daily_revenue"), F.sum("profit").alias("daily_profit"),
        F.count(F.lit(1)).alias("daily_orders"))


def sales_trends_view(star: Star) -> DataFrame:
    """Daily totals with 7 and 30 row averages and the running total of the year."""
    day = ("full_date",)
    return daily_totals(star).select(
        "full_date", "daily_revenue", "daily_profit", "daily_orders",
        moving_average("daily_revenue", 7, day).alias("rolling_7day_revenue_avg"),
        moving_average("daily_revenue", 30, day).alias("rolling_30day_revenue_avg"),
        F.round(running_total("daily_revenue", day, (F.year("full_date"),)), 2).alias("cumulative_ytd_revenue"),
    ).orderBy("full_date")


def monthly_moving_average(star: Star, rows: int = 3) -> DataFrame:
    """Monthly revenue and profit with the mean revenue of the last ``rows`` months."""
    months = star.order_totals(("year", "month"), ("revenue", "profit")).groupBy("year", "month").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"))
    return with_month_name(months).withColumn(
        "revenue_moving_avg", moving_average("total_revenue", rows, ("year", "month"))).orderBy("year", "month")


def profit_waterfall(star: Star) -> DataFrame:
    """Profit per sub-category with the cumulative profit in name order."""
    steps = star.totals(("sub_category",), ("profit",)).select("sub_category", F.col("profit").alias("total_profit"))
    # Rises with the product catalogue's sub-categories, never with sales.
    return steps.withColumn("cumulative_profit", running_total("total_profit", ("sub_category",))).orderBy("sub_category")


def top_customers_view(star: Star) -> DataFrame:
    """Every customer with a dense rank by revenue."""
    customers = customer_totals(star).select(
        "customer_id", "customer_name", F.col("segment").alias("market_segment"),
        F.col("total_sales").alias("gross_sales"), "total_revenue", "total_profit", "total_orders",
        F.col("total_quantity").alias("total_units_purchased"),
        order_value().alias("average_order_value"), margin().alias("customer_profit_margin"))
    return with_rank(customers, "total_revenue", "customer_revenue_rank")


def top_products_view(star: Star) -> DataFrame:
    """Every product with a dense rank by revenue in its category."""
    products = product_totals(star).select(
        "product_id", "product_name", "category_name", "sub_category", F.col("total_sales").alias("gross_sales"),
        "total_revenue", "total_profit", F.col("total_quantity").alias("total_quantity_sold"),
        F.col("average_discount").alias("average_discount_rate"), margin().alias("product_profit_margin"))
    return with_rank(products, "total_revenue", "category_revenue_rank", within=("category_name",))


def _band(score: Column) -> Column:
    return (
        F.when(score >= 10, "Champions")
        .when(score >= 7, "Loyal Customers")
        .when(score >= 5, "At Risk / Need Attention")
        .otherwise("Lost / Hibernating")
    )


def customer_metrics(star: Star) -> DataFrame:
    """Last order, distinct orders and revenue of each customer version."""
    keys = ("customer_key", "customer_id", "customer_name", "segment")
    orders = star.order_totals((*keys, "full_date"), ("revenue",)).withColumnRenamed("full_date", "last_date")
    if not star.order_fixes(*keys, "full_date"):
        # One order may carry several dates, so dates are reduced per order first.
        orders = orders.groupBy(*keys, "order_id").agg(F.max("last_date").alias("last_date"), F.sum("revenue").alias("revenue"))
    return orders.groupBy(*keys).agg(
        F.max("last_date").alias("last_order_date"), F.count(F.lit(1)).alias("order_frequency"),
        F.sum("revenue").alias("monetary_value")).withColumnRenamed("segment", "market_segment")


def rfm_scores(star: Star) -> DataFrame:
    """Recency, frequency and monetary quarters of every customer version."""
    metrics = materialize(customer_metrics(star))
    latest = metrics.agg(F.max("last_order_date")).scalar()
    scored = metrics.withColumn("recency_days", F.datediff(latest, "last_order_date"))
    for name, order in (
        ("r_score", F.desc("recency_days")), ("f_score", F.asc("order_frequency")), ("m_score", F.asc("monetary_value")),
    ):
        scored = with_ntile(scored, 4, (order, "customer_key"), name)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_total_score", total).withColumn("customer_rfm_segment", _band(total))


_RFM = ("customer_id", "customer_name", "market_segment", "last_order_date", "recency_days", "order_frequency",
        "monetary_value", "rfm_total_score")


def customer_segmentation(star: Star) -> DataFrame:
    return rfm_scores(star).select(*_RFM, "customer_rfm_segment").orderBy(F.desc("monetary_value"))


def customer_segmentation_view(star: Star) -> DataFrame:
    return rfm_scores(star).select(*_RFM, "r_score", "f_score", "m_score", "customer_rfm_segment")


def segment_distribution(star: Star) -> DataFrame:
    """Customers, revenue and mean score of each RFM segment."""
    return rfm_scores(star).groupBy("customer_rfm_segment").agg(
        F.count(F.lit(1)).alias("total_customers"), F.sum("monetary_value").alias("total_revenue"),
        ratio(F.sum("rfm_total_score"), F.count(F.lit(1)), 4).alias("average_rfm_score"))
