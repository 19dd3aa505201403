"""Two stars with one interface: stored tables, and the given tables directly.

``lines`` gives order lines with any attributes of the star; ``order_totals``
gives one row per order and attribute combination with summed measures. Counting
its rows per attribute group is the exact number of distinct orders, so a query
that counts only orders needs no COUNT(DISTINCT order_id) over order lines.
"""

from __future__ import annotations

import datetime as dt
from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.sources import commerce

_DATE = ("full_date", "day_of_week", "day_name", "day_of_month", "day_of_year", "week_of_year", "month",
         "month_name", "quarter", "year", "is_weekend", "is_holiday", "fiscal_quarter", "fiscal_year")
_DIMENSIONS = {
    "dim_customer": ("customer_key", ("customer_id", "customer_name", "segment")),
    "dim_product": ("product_key", ("product_id", "product_name", "sub_category")),
    "dim_category": ("category_key", ("category_name",)),
    "dim_region": ("region_key", ("region", "country", "state", "city", "postal_code")),
}


#: First and last order date, both included; None is open.
Period = tuple[dt.date | None, dt.date | None]


def whole_year(year: int | None) -> Period:
    return (None, None) if year is None else (dt.date(year, 1, 1), dt.date(year, 12, 31))


class Star(ABC):
    """Order lines and their dimensions."""

    spark: SparkSession

    @abstractmethod
    def lines(self, *columns: str, where: Column | None = None) -> DataFrame:
        """Order lines with ``columns``; ``where`` may use those columns."""

    @abstractmethod
    def order_totals(self, attributes: Sequence[str], measures: Sequence[str] = (), period: Period = (None, None),
                     equals: Mapping[str, object] | None = None) -> DataFrame:
        """``order_id``, ``attributes``, each measure summed, and ``line_count``.

        Only orders of ``period`` with the values of ``equals`` (attributes of the order) are read and summed.
        """

    @abstractmethod
    def totals(self, keys: Sequence[str], measures: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """``keys``, each measure summed over their lines, and ``line_count``."""

    @abstractmethod
    def order_fixes(self, *attributes: str) -> bool:
        """True if an order can have only one combination of ``attributes``."""

    @abstractmethod
    def dimension(self, name: str) -> DataFrame:
        """A dimension table by its name, such as ``dim_customer``."""


def _sums(measures: Sequence[str]) -> list[Column]:
    return [F.sum(m).alias(m) for m in measures] + [F.count(F.lit(1)).alias("line_count")]


def join_date(facts: DataFrame, dim_date: DataFrame, key: str = "order_date_key") -> DataFrame:
    """Join the calendar. For the order date the year joins too, which lets a
    filter on ``year`` prune the year partitions of the facts."""
    condition = facts[key] == dim_date["date_key"]
    if key == "order_date_key" and "order_year" in facts.columns:
        condition = condition & (facts["order_year"] == dim_date["year"])
    return facts.join(dim_date, condition)


class WarehouseStar(Star):
    """The star over stored dimension and fact tables."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables
        self.spark = tables["fact_sales"].sparkSession

    def dimension(self, name: str) -> DataFrame:
        return self.tables[name]

    def lines(self, *columns: str, where: Column | None = None) -> DataFrame:
        facts = self.tables["fact_sales"]
        wanted = set(columns)
        df = facts
        if wanted & set(_DATE):
            days = self.tables["dim_date"].select("date_key", *_DATE)
            df = join_date(df, days)
        if wanted & {"ship_date", "ship_day"}:
            ships = self.tables["dim_date"].select(F.col("date_key").alias("_ship_key"), F.col("full_date").alias("ship_date"))
            df = df.join(ships, df["ship_date_key"] == ships["_ship_key"])
        for name, (key, attributes) in _DIMENSIONS.items():
            used = [a for a in attributes if a in wanted]
            if used:
                df = df.join(self.tables[name].select(key, *used), key)
        derived = {"discount_amount": F.col("sales") * F.col("discount")}
        if "ship_day" in wanted:
            derived["ship_day"] = F.unix_date("ship_date")
        df = df.withColumns(derived)
        if where is not None:
            df = df.filter(where)
        return df.select(*columns)

    def order_fixes(self, *attributes: str) -> bool:
        return not attributes

    def totals(self, keys: Sequence[str], measures: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        return self.lines(*keys, *measures, where=where).groupBy(*keys).agg(*_sums(measures))

    def order_totals(self, attributes: Sequence[str], measures: Sequence[str] = (), period: Period = (None, None),
                     equals: Mapping[str, object] | None = None) -> DataFrame:
        start, end = period
        where = F.lit(True)
        for day, key, compare in ((start, _key(start), "__ge__"), (end, _key(end), "__le__")):
            if day is not None:
                where &= getattr(F.col("order_date_key"), compare)(key) & getattr(F.col("order_year"), compare)(day.year)
        for name, value in (equals or {}).items():
            where &= F.col(name) == value
        keys, extra = ("order_id", *attributes), ("order_date_key", "order_year", *(equals or {}))
        lines = self.lines(*dict.fromkeys((*keys, *measures, *extra)), where=where)
        return lines.groupBy(*keys).agg(*_sums(measures))


def _key(day: dt.date | None) -> int | None:
    return None if day is None else day.year * 10000 + day.month * 100 + day.day


def _dated(start: dt.date | None, end: dt.date | None) -> Column | None:
    """The period as a range of ``o_orderdate`` itself, which reaches the files."""
    midnight = lambda day: F.lit(dt.datetime.combine(day, dt.time()))
    parts = [] if start is None else [F.col("o_orderdate") >= midnight(start)]
    parts += [] if end is None else [F.col("o_orderdate") < midnight(end + dt.timedelta(days=1))]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0] & parts[1]


class SourceStar(Star):
    """The star over the given commerce tables, without storing anything."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def dimension(self, name: str) -> DataFrame:
        read = lambda table: commerce.read(self.spark, self.folder, table)
        if name == "dim_customer":
            return read("customer").select(
                F.col("c_custkey").alias("customer_key"), F.col("c_custkey").cast("string").alias("customer_id"),
                F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"),
                F.lit(True).alias("is_current"))
        if name == "dim_product":
            return read("part").select(
                F.col("p_partkey").alias("product_key"), F.col("p_partkey").cast("string").alias("product_id"),
                F.col("p_name").alias("product_name"), F.col("p_brand").alias("sub_category"),
                F.concat_ws("|", "p_type", "p_brand").alias("category_key"))
        if name == "dim_category":
            return read("part").select(
                F.concat_ws("|", "p_type", "p_brand").alias("category_key"),
                F.col("p_type").alias("category_name"), F.col("p_brand").alias("sub_category")).distinct()
        raise KeyError(name)

    def order_fixes(self, *attributes: str) -> bool:
        return all(commerce.is_order_level(a) for a in attributes)

    def lines(self, *columns: str, where: Column | None = None) -> DataFrame:
        df = commerce.order_lines(self.spark, self.folder, *columns)
        return df if where is None else df.filter(where)

    def order_totals(self, attributes: Sequence[str], measures: Sequence[str] = (), period: Period = (None, None),
                     equals: Mapping[str, object] | None = None) -> DataFrame:
        """Sum the lines per order before anything about the order is joined.

        ``orders`` and ``customer`` then meet one row per order instead of every
        line, and the join reuses the partitioning of the aggregation. With a period or values the orders
        are chosen first, by conditions that reach the files, and only their lines are summed.
        """
        spark, folder = self.spark, self.folder
        equals = {name: value for name, value in (equals or {}).items() if value is not None}
        dated = _dated(*period)
        line_level = [a for a in attributes if not commerce.is_order_level(a)]
        order_level = [a for a in attributes if commerce.is_order_level(a)]
        if not all(map(commerce.is_order_level, equals)):
            raise ValueError("only attributes of an order choose orders")
        lines = self._priced((*line_level, *measures))
        if dated is not None or equals:
            orders = commerce.read(spark, folder, "orders")
            if dated is not None:
                orders = orders.filter(dated)
            chosen = commerce.join_tables(spark, folder, orders, commerce.tables_for(tuple(equals)) - {"orders"})
            for name, value in equals.items():
                chosen = chosen.filter(commerce.expression(name) == value)
            lines = lines.join(chosen.select(F.col("o_orderkey").alias("chosen_order")), F.col("l_orderkey") == F.col("chosen_order"), "left_semi")
        per_order = self._summed(lines, [F.col("l_orderkey")], line_level, measures)
        joined = commerce.join_tables(spark, folder, per_order, commerce.tables_for(tuple(order_level)))
        if dated is not None and "orders" in commerce.tables_for(tuple(order_level)):
            joined = joined.filter(dated)
        return joined.select(
            commerce.expression("order_id"), *line_level, *[commerce.expression(c) for c in order_level],
            *measures, "line_count",
        ).select("order_id", *attributes, *measures, "line_count")

    def totals(self, keys: Sequence[str], measures: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        lines = self._priced((*keys, *measures))
        if where is not None:
            lines = lines.withColumns({c: commerce.expression(c) for c in (*keys, *measures)}).filter(where)
        return self._summed(lines, [], keys, measures)

    def _priced(self, columns: Sequence[str]) -> DataFrame:
        base = commerce.read(self.spark, self.folder, "lineitem")
        return commerce.priced(commerce.join_tables(self.spark, self.folder, base, commerce.tables_for(tuple(columns))))

    @staticmethod
    def _summed(lines: DataFrame, native: list[Column], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Sum whole numbers per key, then turn the sums into amounts."""
        sums, reads = zip(*[commerce.summed(m) for m in measures]) if measures else ((), ())
        grouped = lines.groupBy(*native, *[commerce.expression(k) for k in keys]).agg(
            *sums, F.count(F.lit(1)).alias("line_count"))
        return grouped.select(*native, *keys, *reads, "line_count")


class SlicedStar(Star):
    """A star limited to given attribute values, such as one region of a role."""

    def __init__(self, star: Star, **values) -> None:
        self.star = star
        self.spark = star.spark
        self.values = {name: value for name, value in values.items() if value is not None}

    def _limited(self, df: DataFrame) -> DataFrame:
        for name, value in self.values.items():
            df = df.filter(F.col(name) == value)
        return df

    def _with(self, columns: Sequence[str]) -> list[str]:
        return [*columns, *[name for name in self.values if name not in columns]]

    def lines(self, *columns: str, where: Column | None = None) -> DataFrame:
        df = self._limited(self.star.lines(*self._with(columns)))
        return (df if where is None else df.filter(where)).select(*columns)

    def order_totals(self, attributes: Sequence[str], measures: Sequence[str] = (), period: Period = (None, None),
                     equals: Mapping[str, object] | None = None) -> DataFrame:
        fixed = {n: v for n, v in self.values.items() if self.star.order_fixes(n) or isinstance(self.star, WarehouseStar)}
        rest = [n for n in self.values if n not in fixed]
        df = self.star.order_totals(list(dict.fromkeys((*attributes, *rest))), measures, period, {**fixed, **(equals or {})})
        for name in rest:
            df = df.filter(F.col(name) == self.values[name])
        return df.select("order_id", *attributes, *measures, "line_count")

    def totals(self, keys: Sequence[str], measures: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        df = self._limited(self.star.totals(self._with(keys), measures, where))
        return df.select(*keys, *measures, "line_count")

    def order_fixes(self, *attributes: str) -> bool:
        return self.star.order_fixes(*attributes)

    def dimension(self, name: str) -> DataFrame:
        return self.star.dimension(name)


# The region each regional manager may see.
ROLE_REGIONS = {
    "East Manager": "East",
    "West Manager": "West",
    "Central Manager": "Central",
    "South Manager": "South",
}


def secured(star: Star, role: str, roles: dict[str, str] | None = None) -> Star:
    """The part of the star a role may see; an unknown role sees nothing."""
    roles = ROLE_REGIONS if roles is None else roles
    if role not in roles:
        raise PermissionError(f"no such role: {role}")
    return SlicedStar(star, region=roles[role])
