"""The parameterised analytics queries over a star.

Amounts stay exact decimals until the last step; ratios are rounded half away
from zero. ``None`` as a filter value means no filter.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numbers import ratio
from tillstar.plans.star import Star, whole_year

_MONEY = ("sales", "revenue", "profit")
_MONEY_UNITS = (*_MONEY, "quantity")


def _total(measure: str, name: str | None = None) -> Column:
    return F.sum(measure).alias(name or f"total_{measure}")


def _orders(name: str = "total_orders") -> Column:
    """Distinct orders: one row of ``order_totals`` per order and group."""
    return F.count(F.lit(1)).alias(name)


def margin(profit: str = "total_profit", revenue: str = "total_revenue") -> Column:
    return ratio(F.col(profit), F.col(revenue), 4)


def order_value(revenue: str = "total_revenue", orders: str = "total_orders") -> Column:
    return ratio(F.col(revenue), F.col(orders), 2)


def _equals(df: DataFrame, **filters) -> DataFrame:
    for column, value in filters.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def with_month_name(df: DataFrame) -> DataFrame:
    """Month names of already grouped rows, placed after ``month``."""
    name = F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMMM")
    at = df.columns.index("month") + 1
    return df.withColumn("month_name", name).select(*df.columns[:at], "month_name", *df.columns[at:])


def revenue_by_month(star: Star, year: int | None = None) -> DataFrame:
    months = (
        star.order_totals(("year", "month"), _MONEY_UNITS, whole_year(year))
        .groupBy("year", "month")
        .agg(*[_total(m) for m in _MONEY_UNITS], _orders())
        .withColumn("average_order_value", order_value())
        .withColumn("profit_margin", margin())
    )
    return with_month_name(months).orderBy("year", "month")


def monthly_revenue_view(star: Star) -> DataFrame:
    months = revenue_by_month(star)
    return months.select(
        "year", "month", "month_name", F.col("total_sales").alias("gross_sales"),
        F.col("total_revenue").alias("net_revenue"), "total_profit",
        F.col("total_quantity").alias("total_units_sold"), "total_orders", "average_order_value",
        F.col("profit_margin").alias("net_profit_margin"))


def customer_totals(star: Star) -> DataFrame:
    return (
        star.order_totals(("customer_id", "customer_name", "segment"), _MONEY_UNITS)
        .groupBy("customer_id", "customer_name", "segment")
        .agg(*[_total(m) for m in _MONEY_UNITS], _orders())
    )


def top_customers(star: Star, limit: int = 10) -> DataFrame:
    return (
        customer_totals(star)
        .select("customer_id", "customer_name", "segment", "total_sales", "total_revenue", "total_profit",
                "total_orders", margin().alias("profit_margin"))
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(limit)
    )


_PRODUCT = ("product_id", "product_name", "category_name", "sub_category")


def product_totals(star: Star, category: str | None = None) -> DataFrame:
    totals = _equals(star.totals(_PRODUCT, (*_MONEY_UNITS, "discount")), category_name=category)
    return totals.withColumnsRenamed({m: f"total_{m}" for m in _MONEY_UNITS}).withColumns({
        "total_discounts_granted": F.col("total_sales") - F.col("total_revenue"),
        "average_discount": ratio(F.col("discount"), F.col("line_count"), 4),
    })


def top_products(star: Star, limit: int = 10, category: str | None = None) -> DataFrame:
    return (
        product_totals(star, category)
        .select(*_PRODUCT, "total_sales", "total_revenue", "total_profit", "total_quantity", "average_discount")
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


def regional_performance(star: Star) -> DataFrame:
    keys = ("region", "country", "state")
    return (
        star.order_totals(keys, _MONEY).groupBy(*keys)
        .agg(*[_total(m) for m in _MONEY], _orders())
        .withColumn("profit_margin", margin())
        .orderBy("region", F.desc("total_revenue"))
    )


def regional_performance_view(star: Star) -> DataFrame:
    keys = ("region", "country", "state", "city")
    return (
        star.order_totals(keys, _MONEY_UNITS).groupBy(*keys)
        .agg(_total("sales", "gross_sales"), _total("revenue"), _total("profit"),
             _total("quantity", "total_units_sold"), _orders())
        .withColumn("regional_profit_margin", margin())
        .orderBy("region", F.desc("total_revenue"))
    )


_GRAINS = {"daily": ("full_date",), "weekly": ("year", "week_of_year"), "quarterly": ("year", "quarter")}


def sales_trends(star: Star, granularity: str = "monthly") -> DataFrame:
    keys = _GRAINS.get(granularity, ("year", "month"))
    trend = star.order_totals(keys, _MONEY).groupBy(*keys).agg(*[_total(m) for m in _MONEY], _orders())
    return (trend if granularity in _GRAINS else with_month_name(trend)).orderBy(*keys)


_BREAKDOWNS = {
    "product": _PRODUCT,
    "region": ("region", "state", "city"),
    "customer": ("customer_id", "customer_name", "segment"),
}


def profitability_analysis(star: Star, by: str = "category") -> DataFrame:
    keys = _BREAKDOWNS.get(by, ("category_name", "ship_mode"))
    if star.order_fixes(*keys):
        rows = star.order_totals(keys, _MONEY)  # joins orders to their totals, not to every line
    else:
        rows = star.totals(keys, _MONEY)
    return (
        rows.groupBy(*keys).agg(*[_total(m) for m in _MONEY])
        .withColumn("profit_margin", margin())
        .orderBy(F.desc("total_revenue"))
    )


def profitability_view(star: Star) -> DataFrame:
    return product_totals(star).select(
        "category_name", "sub_category", "product_id", "product_name", F.col("total_sales").alias("gross_sales"),
        "total_revenue", "total_profit", F.col("total_quantity").alias("total_units_sold"),
        margin().alias("profit_margin"), "total_discounts_granted",
        F.col("average_discount").alias("average_discount_rate"))


def count_orders_and_customers(star: Star, orders: DataFrame, keys: tuple[str, ...], sums: dict[str, str]) -> DataFrame:
    """Sums per ``keys`` with distinct orders and customers, from order totals.

    Two distinct counts would repeat every order row. Where an order has one customer, two plain aggregations replace
    them; else orders and customers are counted apart, each as rows of a grouping, and put together.
    """
    if star.order_fixes("customer_key", *keys):
        customers = orders.groupBy(*keys, "customer_key").agg(
            *[F.sum(m).alias(m) for m in sums], F.count(F.lit(1)).alias("_orders"))
        counts = [F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"), F.count(F.lit(1)).alias("total_customers")]
        rows = customers
    else:
        pairs = orders.groupBy(*keys, "order_id", "customer_key").agg(*[F.sum(m).alias(m) for m in sums])
        by_order = pairs.groupBy(*keys, "order_id").agg(*[F.sum(m).alias(m) for m in sums]).groupBy(*keys).agg(
            *[F.sum(m).alias(m) for m in sums], F.count("order_id").alias("_orders"))
        by_customer = pairs.select(*keys, "customer_key").distinct().groupBy(*keys).agg(F.count("customer_key").alias("_customers"))
        counts = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_orders", "total_orders"), ("_customers", "total_customers"))]
        rows = by_order.unionByName(by_customer, allowMissingColumns=True)
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(name) for m, name in sums.items()], *counts)


def get_kpis(star: Star) -> DataFrame:
    """One row of headline figures; zeros for an empty star."""
    totals = count_orders_and_customers(
        star, star.order_totals(("customer_key",), _MONEY_UNITS), (),
        {"sales": "gross_sales", "revenue": "net_revenue", "profit": "total_profit", "quantity": "total_quantity"})
    kpis = totals.withColumn("average_order_value", order_value("net_revenue")).withColumn(
        "net_profit_margin", margin(revenue="net_revenue"))
    return kpis.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in kpis.columns])


def discount_impact(star: Star) -> DataFrame:
    return (
        star.totals(("discount",), _MONEY_UNITS)
        .withColumnsRenamed({**{m: f"total_{m}" for m in _MONEY}, "discount": "discount_rate",
                             "line_count": "transaction_count", "quantity": "total_units_sold"})
        .withColumn("profit_margin", margin())
        .select("discount_rate", "transaction_count", "total_sales", "total_revenue", "total_profit",
                "profit_margin", "total_units_sold")
        .orderBy("discount_rate")
    )


def _key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def in_period(start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive range of ``order_date_key``; ``order_year`` prunes partitions."""
    if start and end and start > end:
        raise ValueError(f"start {start} is after end {end}")
    low, high = _key(start) if start else 0, _key(end) if end else 99_999_999
    years = F.col("order_year").between(low // 10_000, high // 10_000)
    return F.col("order_date_key").between(low, high) & years


def sales_summary(star: Star, start: dt.date | None = None, end: dt.date | None = None,
                  region: str | None = None) -> DataFrame:
    """Totals of a period and region as one row."""
    if start and end and start > end:
        raise ValueError(f"start {start} is after end {end}")
    equals = {} if region is None else {"region": region}
    rows = star.order_totals(("customer_key",), ("revenue", "profit", "quantity"), (start, end), equals)
    totals = count_orders_and_customers(
        star, rows, (), {"revenue": "total_revenue", "profit": "total_profit", "quantity": "total_units_sold"})
    totals = totals.withColumn("avg_order_value", order_value()).withColumn("profit_margin", margin())
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("total_revenue", "total_profit", "total_units_sold")}
    return totals.withColumns(zeros)


def monthly_summary(star: Star, year: int, month: int) -> DataFrame:
    """Four (metric_name, metric_value) rows of one month."""
    last = calendar.monthrange(year, month)[1]
    rows = star.order_totals((), ("revenue", "profit"), (dt.date(year, month, 1), dt.date(year, month, last)))
    zero = F.lit(0).cast("decimal(12,2)")
    totals = rows.agg(
        F.coalesce(F.sum("revenue"), zero).alias("revenue"),
        F.coalesce(F.sum("profit"), zero).alias("profit"),
        F.count_distinct("order_id").alias("orders"),
    ).withColumn("value", F.coalesce(order_value("revenue", "orders"), zero))
    return totals.select([F.col(c).cast("decimal(38,2)").alias(c) for c in totals.columns]).select(F.expr(
        "stack(4, 'Monthly Revenue', revenue, 'Monthly Profit', profit, 'Monthly Orders', orders, "
        "'Average Order Value', value) AS (metric_name, metric_value)"))


def monthly_growth(star: Star) -> DataFrame:
    """Growth against the previous month that has sales."""
    months = star.order_totals(("year", "month"), ("revenue",)).groupBy("year", "month").agg(_total("revenue", "monthly_revenue"))
    prior = F.lag("monthly_revenue").over(Window.orderBy("year", "month"))
    change = F.col("monthly_revenue") - F.col("prior_month_revenue")
    return (
        with_month_name(months)
        .withColumn("prior_month_revenue", prior)
        .withColumn("mom_growth_pct", ratio(change * 100, F.col("prior_month_revenue"), 2))
        .orderBy("year", "month")
    )


def loss_makers(star: Star) -> DataFrame:
    """Products whose losing lines add up to a loss, with that loss."""
    return star.totals(("product_key",), ("profit",), where=F.col("profit") < 0).withColumnsRenamed(
        {"profit": "total_loss", "line_count": "losing_lines"})
