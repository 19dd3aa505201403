"""The business measures, as columns over order totals and as small tables.

The column measures expect the columns of :meth:`Star.order_totals` and work under
any grouping. Shares and rates are plain doubles with 0 where undefined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.numbers import safe_divide
from tillstar.operators.ranking import with_rank
from tillstar.plans.star import Star, whole_year
from tillstar.plans.trends import running_total

ADDITIVE = ("sales", "revenue", "profit", "quantity", "discount", "discount_amount", "ship_day")


def gross_sales() -> Column:
    return F.sum("sales")


def discount_amount() -> Column:
    return F.sum("discount_amount")


def revenue() -> Column:
    return F.sum("revenue")


def profit() -> Column:
    return F.sum("profit")


def cost() -> Column:
    return revenue() - profit()


def profit_margin() -> Column:
    return safe_divide(profit(), revenue())


def orders() -> Column:
    return F.count_distinct("order_id")


def units() -> Column:
    return F.sum("quantity")


def customers() -> Column:
    return F.count_distinct("customer_key")


def average_order_value() -> Column:
    return safe_divide(revenue(), orders())


def average_unit_price() -> Column:
    return safe_divide(gross_sales(), units())


def revenue_per_customer() -> Column:
    return safe_divide(revenue(), customers())


def average_discount() -> Column:
    return safe_divide(F.sum("discount"), F.sum("line_count"))


def average_shipping_days() -> Column:
    """Mean days from order to shipment; needs ``full_date`` on the order totals."""
    ordered = F.col("line_count") * F.unix_date("full_date")
    return safe_divide(F.sum(F.col("ship_day") - ordered), F.sum("line_count"))


MEASURES = {
    "gross_sales": gross_sales, "discount_amount": discount_amount, "revenue": revenue, "cost": cost, "profit": profit,
    "profit_margin": profit_margin, "average_order_value": average_order_value, "average_unit_price": average_unit_price,
    "orders": orders, "units": units, "customers": customers, "revenue_per_customer": revenue_per_customer,
    "average_discount": average_discount, "average_shipping_days": average_shipping_days,
}


def measure_table(star: Star, by: Sequence[str], names: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """The named measures for each combination of ``by``."""
    extra = [a for a in ("customer_key", "full_date") if a not in by]
    totals = star.order_totals((*by, *extra), ADDITIVE)
    return totals.groupBy(*by).agg(*[MEASURES[n]().alias(n) for n in names])


def active_customer_ratio(star: Star) -> DataFrame:
    """Customer versions with sales, over all customers of the dimension."""
    buyers = star.totals(("customer_key",), ("sales",), where=F.col("sales") > 0).agg(F.count(F.lit(1)).alias("n"))
    known = star.dimension("dim_customer").agg(F.count_distinct("customer_id")).scalar()
    return buyers.select(safe_divide(F.col("n"), known).alias("active_customer_ratio"))


def daily_revenue(star: Star) -> DataFrame:
    return star.order_totals(("full_date",), ("revenue",)).groupBy("full_date").agg(F.sum("revenue").alias("revenue"))


def to_date_revenue(star: Star) -> DataFrame:
    """Running revenue of the month, quarter and year for every day with sales."""
    day, order = F.col("full_date"), ("full_date",)
    return daily_revenue(star).select(
        "full_date", "revenue",
        running_total("revenue", order, (F.year(day), F.month(day))).alias("revenue_mtd"),
        running_total("revenue", order, (F.year(day), F.quarter(day))).alias("revenue_qtd"),
        running_total("revenue", order, (F.year(day),)).alias("revenue_ytd"))


def _growth(now: str, before: str) -> Column:
    return safe_divide(F.col(now) - F.col(before), F.col(before))


def year_over_year(star: Star) -> DataFrame:
    """Revenue of each day and of the same day a year earlier, with the growth."""
    days = daily_revenue(star)
    earlier = days.select(F.col("full_date").alias("_day"), F.col("revenue").alias("prior_year_revenue"))
    joined = days.join(earlier, F.add_months("full_date", -12) == F.col("_day"), "left").drop("_day")
    return joined.withColumn("yoy_growth", _growth("revenue", "prior_year_revenue"))


def _months(star: Star) -> DataFrame:
    months = star.order_totals(("year", "month"), ("revenue",)).groupBy("year", "month").agg(F.sum("revenue").alias("revenue"))
    return months.withColumn("_index", F.col("year") * 12 + F.col("month"))


def month_over_month(star: Star) -> DataFrame:
    """Revenue of each month and of the calendar month before, with the growth."""
    months = _months(star)
    earlier = months.select((F.col("_index") + 1).alias("_index"), F.col("revenue").alias("prior_month_revenue"))
    return months.join(earlier, "_index", "left").drop("_index").withColumn(
        "mom_growth", _growth("revenue", "prior_month_revenue"))


def product_rank(star: Star) -> DataFrame:
    """Products ranked by revenue; equal revenue shares a rank and leaves a gap."""
    products = star.totals(("product_id",), ("revenue",)).drop("line_count")
    return with_rank(products, "revenue", "product_sales_rank", dense=False)


def lifetime_value(star: Star) -> DataFrame:
    """Revenue of each customer over all versions."""
    return star.order_totals(("customer_id",), ("revenue",)).groupBy("customer_id").agg(F.sum("revenue").alias("lifetime_value"))


def retention(star: Star) -> DataFrame:
    """Per year: customers, those of the year before, and how many of them returned."""
    active = star.order_totals(("year", "customer_key")).groupBy("year", "customer_key").agg(F.lit(1).alias("here"))
    none, one = F.lit(None).cast("int"), F.lit(1)
    marks = F.array(
        F.struct(F.col("year").alias("year"), one.alias("here"), none.alias("before")),
        F.struct((F.col("year") + 1).alias("year"), none.alias("here"), one.alias("before")))
    both = active.select("customer_key", F.inline(marks)).groupBy("year", "customer_key").agg(
        F.max("here").alias("here"), F.max("before").alias("before"))
    years = both.groupBy("year").agg(
        F.count("here").alias("current_customers"), F.count("before").alias("prior_customers"),
        F.count_if(F.col("here").isNotNull() & F.col("before").isNotNull()).alias("retained_customers"))
    # The year after the last one has no sales and is no period of the data.
    return years.filter("current_customers > 0").withColumn(
        "retention_rate", safe_divide(F.col("retained_customers"), F.col("prior_customers")))


def returning_customers(star: Star, year: int) -> DataFrame:
    """Customers with orders in ``year`` and in the year before."""
    def of(y: int) -> DataFrame:
        return star.order_totals(("customer_key",), (), whole_year(y)).select("customer_key")

    return of(year).intersect(of(year - 1))
