"""Monthly revenue forecast by additive exponential smoothing, one series per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.plans.star import Star


def revenue_forecast(star: Star, by: str = "category_name", months: int = 6, season: int = 12,
                     z: float = 1.959963984540054, level: float = 0.3, trend: float = 0.05, seasonal: float = 0.2) -> DataFrame:
    """The next ``months`` months of each series with 95 % bounds.

    Level, trend and season are smoothed with fixed weights over all months from the first to the last, months without
    sales being zero. One rule holds for every length: the level starts as the mean of the first season, as far as
    there is one, a seasonal term as what its first month differs from that, or zero before it is seen, and the trend at zero. The spread
    is the root of the mean squared one-month error. A group holds a row per month; the smoothing is an
    aggregation over that array, so it runs inside Spark.
    """
    monthly = star.order_totals((by, "year", "month"), ("revenue",)).groupBy(F.col(by).alias("series"), (F.col("year") * 12 + F.col("month") - 1).alias("m")).agg(
        F.sum("revenue").cast("double").alias("revenue"))
    series = monthly.groupBy("series").agg(
        F.min("m").alias("first"), F.max("m").alias("last"), F.map_from_entries(F.collect_list(F.struct("m", "revenue"))).alias("known"))
    values = F.transform(F.sequence("first", "last"), lambda m: F.coalesce(F.try_element_at("known", m), F.lit(0.0)))
    filled = series.select("series", "last", values.alias("values")).withColumn("head", F.slice("values", 1, season))
    started = filled.withColumn("start", F.aggregate("head", F.lit(0.0), lambda s, v: s + v) / F.size("head"))
    terms = F.transform(F.sequence(F.lit(1), F.lit(season)), lambda k: F.coalesce(F.get("head", k - 1) - F.col("start"), F.lit(0.0)))
    begin = F.struct(F.col("start").alias("level"), F.lit(0.0).alias("trend"), terms.alias("terms"), F.lit(0.0).alias("squares"), F.lit(0).alias("i"))

    def step(s: Column, v: Column) -> Column:
        place = s["i"] % season
        term = F.get(s["terms"], place)
        error = v - (s["level"] + s["trend"] + term)
        now = level * (v - term) + (1 - level) * (s["level"] + s["trend"])
        return F.struct(
            now.alias("level"), (trend * (now - s["level"]) + (1 - trend) * s["trend"]).alias("trend"),
            F.transform(s["terms"], lambda t, k: F.when(k == place, seasonal * (v - now) + (1 - seasonal) * t).otherwise(t)).alias("terms"),
            (s["squares"] + error * error).alias("squares"), (s["i"] + 1).alias("i"))

    ended = started.select("series", "last", F.aggregate("values", begin, step).alias("s")).select("series", "last", "s.*")
    ahead = ended.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(months))))
    center = F.col("level") + F.col("h") * F.col("trend") + F.get("terms", ((F.col("i") + F.col("h") - 1) % season).cast("int"))
    width = z * F.sqrt(F.col("squares") / F.col("i")) * F.sqrt(1 + (F.col("h") - 1) * level * level)
    month = F.col("last") + F.col("h")
    return ahead.select(
        "series", F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1)).alias("month_start"),
        F.round(center, 2).alias("forecast"), F.round(center - width, 2).alias("lower_bound"), F.round(center + width, 2).alias("upper_bound"))
