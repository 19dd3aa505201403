"""The given commerce tables seen as order lines.

``lineitem``, ``orders``, ``customer``, ``nation``, ``region`` and ``part`` carry
everything an order line needs. Every foreign key resolves, so a join is left out
whenever none of its columns is asked for.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.schemas import RAW_COLUMNS


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _half(value: str) -> str:
    """A whole number of hundredths of cents as cents, rounded half away from zero."""
    return f"({value} + if({value} < 0, -50, 50)) div 100"


def priced(lines: DataFrame) -> DataFrame:
    """Add the amounts of each line as whole cents.

    The tables hold amounts of at most two decimals as doubles. Whole numbers are
    exact, and far cheaper to multiply and sum than wide decimals. Columns nobody
    asks for are pruned away.
    """
    def whole(column: str) -> Column:
        return F.floor(F.col(column) * 100 + 0.5)

    cents = {"_sales": whole("l_extendedprice"), "_discount": whole("l_discount"), "_quantity": F.col("l_quantity").cast("bigint")}
    if "p_retailprice" in lines.columns:
        cents["_retail"] = whole("p_retailprice")
    net = {"_net": F.expr("_sales * (100 - _discount)")}
    amounts = {"_revenue": F.expr(_half("_net"))}
    if "_retail" in cents:
        net["_gain"] = F.expr("_sales * (100 - _discount) - 95 * _quantity * _retail")
        amounts["_profit"] = F.expr(_half("_gain"))
    return lines.withColumns(cents).withColumns(net).withColumns(amounts)


def amount(cents: Column, scale: int = 2) -> Column:
    """A sum of hundredths (or of 10^-scale) as an exact decimal."""
    step = F.lit(Decimal(1).scaleb(-scale))
    return cents.cast("decimal(20,0)") * step


def _money(column: str) -> Column:
    return amount(F.col(column)).cast("decimal(12,2)")


# Measure -> (whole-number column, decimals). Sums of these stay within 64 bits up
# to 9e16 currency units per group; beyond, Spark reports an overflow.
WHOLE = {
    "sales": ("_sales", 2),
    "revenue": ("_revenue", 2),
    "profit": ("_profit", 2),
    "discount": ("_discount", 2),
    "quantity": ("_quantity", 0),
}


def summed(measure: str) -> tuple[Column, Column]:
    """How to sum a measure over priced lines, and how to read the sum afterwards."""
    if measure in WHOLE:
        column, scale = WHOLE[measure]
        total = F.col(measure) if scale == 0 else amount(F.col(measure), scale)
        return F.sum(column).alias(measure), total.alias(measure)
    return F.sum(ATTRIBUTES[measure][1]()).alias(measure), F.col(measure)


def _margin() -> Column:
    share = F.try_divide(F.col("_profit").cast("decimal(18,0)"), F.col("_sales").cast("decimal(18,0)"))
    clipped = F.greatest(F.lit(-10), F.least(F.lit(1), share))
    return F.when(F.col("_sales") > 0, clipped).otherwise(F.lit(0)).cast("decimal(6,4)")


def line_id() -> Column:
    """Text that identifies a line; ``lineitem`` itself has no key."""
    ship_day = dates.date_key(F.to_date("l_shipdate"))
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship_day)


def order_date() -> Column:
    return F.to_date("o_orderdate")


def ship_date() -> Column:
    return F.to_date("l_shipdate")


def _nation_slice(prefix: str, slices: int) -> Column:
    return F.concat(F.col("n_name"), F.lit(prefix), (F.col("o_custkey") % slices).cast("string"))


def _postal() -> Column:
    number = F.col("c_nationkey") * 100 + F.col("o_custkey") % 9
    return F.lpad(number.cast("string"), 5, "0")


# Attribute -> (tables it needs beyond lineitem, expression).
ATTRIBUTES: dict[str, tuple[tuple[str, ...], callable]] = {
    "sales_key": ((), line_id),
    "order_id": ((), lambda: F.col("l_orderkey").cast("string")),
    "sales": ((), lambda: _money("_sales")),
    "quantity": ((), lambda: F.col("_quantity").cast("int")),
    "discount": ((), lambda: amount(F.col("_discount")).cast("decimal(5,2)")),
    "revenue": ((), lambda: _money("_revenue")),
    "profit": (("part",), lambda: _money("_profit")),
    "profit_margin": (("part",), _margin),
    "ship_date": ((), ship_date),
    "ship_date_key": ((), lambda: dates.date_key(ship_date())),
    "ship_day": ((), lambda: F.unix_date(ship_date())),
    "discount_amount": ((), lambda: amount(F.expr("_sales * _discount"), 4)),
    "ship_mode": (("orders",), lambda: F.col("o_orderpriority")),
    "order_date_key": (("orders",), lambda: dates.date_key(order_date())),
    "full_date": (("orders",), order_date),
    "order_year": (("orders",), lambda: F.year(order_date())),
    "year": (("orders",), lambda: F.year(order_date())),
    "quarter": (("orders",), lambda: F.quarter(order_date())),
    "month": (("orders",), lambda: F.month(order_date())),
    "month_name": (("orders",), lambda: dates.month_name(order_date())),
    "week_of_year": (("orders",), lambda: F.weekofyear(order_date())),
    "day_of_week": (("orders",), lambda: dates.iso_day_of_week(order_date())),
    "day_name": (("orders",), lambda: dates.day_name(order_date())),
    "customer_key": (("orders",), lambda: F.col("o_custkey")),
    "customer_id": (("orders",), lambda: F.col("o_custkey").cast("string")),
    "customer_name": (("orders", "customer"), lambda: F.col("c_name")),
    "segment": (("orders", "customer"), lambda: F.col("c_mktsegment")),
    "region": (("orders", "customer", "nation", "region"), lambda: F.col("r_name")),
    "country": (("orders", "customer", "nation"), lambda: F.col("n_name")),
    "state": (("orders", "customer", "nation"), lambda: _nation_slice("_S", 3)),
    "city": (("orders", "customer", "nation"), lambda: _nation_slice("_C", 9)),
    "postal_code": (("orders", "customer"), _postal),
    "product_key": ((), lambda: F.col("l_partkey")),
    "product_id": ((), lambda: F.col("l_partkey").cast("string")),
    "product_name": (("part",), lambda: F.col("p_name")),
    "category_name": (("part",), lambda: F.col("p_type")),
    "sub_category": (("part",), lambda: F.col("p_brand")),
}

# Table -> (foreign key, primary key), in join order.
_JOINS = {
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
}


def tables_for(columns: tuple[str, ...]) -> set[str]:
    """Tables beyond ``lineitem`` that ``columns`` need."""
    return {table for name in columns for table in ATTRIBUTES[name][0]}


def is_order_level(column: str) -> bool:
    """True if the value is the same on every line of an order."""
    needs = ATTRIBUTES[column][0]
    return column == "order_id" or "orders" in needs


def expression(column: str) -> Column:
    return ATTRIBUTES[column][1]().alias(column)


def join_tables(spark: SparkSession, folder: str, base: DataFrame, tables: set[str]) -> DataFrame:
    """Inner-join the named tables to ``base``; their sizes decide how."""
    def step(df: DataFrame, table: str) -> DataFrame:
        foreign, primary = _JOINS[table]
        return df.join(read(spark, folder, table), F.col(foreign) == F.col(primary))

    return reduce(step, [t for t in _JOINS if t in tables], base)


def order_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines with the asked columns, joining only what those need."""
    base = read(spark, folder, "lineitem")
    joined = priced(join_tables(spark, folder, base, tables_for(columns)))
    return joined.select(*[expression(c) for c in columns])


_RAW_FROM = {
    "Row ID": "sales_key", "Order ID": "order_id", "Order Date": "full_date", "Ship Date": "ship_date",
    "Ship Mode": "ship_mode", "Customer ID": "customer_id", "Customer Name": "customer_name",
    "Segment": "segment", "Country": "country", "City": "city", "State": "state",
    "Postal Code": "postal_code", "Region": "region", "Product ID": "product_id",
    "Category": "category_name", "Sub-Category": "sub_category", "Product Name": "product_name",
    "Sales": "sales", "Quantity": "quantity", "Discount": "discount", "Profit": "profit",
}


def _cents_text(column: str) -> Column:
    """The text of :func:`_money`; whole numbers are put into words faster than wide decimals."""
    cents = F.abs(F.col(column))
    text = F.concat(F.when(F.col(column) < 0, "-").otherwise(""), F.expr(f"abs({column}) div 100").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.when(cents < 10**12, text).otherwise(_money(column).cast("string"))


_RAW_TEXT = {"Sales": lambda: _cents_text("_sales"), "Profit": lambda: _cents_text("_profit")}


def raw_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The 21 text columns of an order-line file, one row per ``lineitem`` row."""
    # A customer's columns join the orders, of which there are fewer, and not the lines that already carry the others.
    # The names of nations and regions come last: before, they would be shuffled with every order.
    orders = join_tables(spark, folder, read(spark, folder, "orders"), {"customer"})
    joined = join_tables(spark, folder, read(spark, folder, "lineitem"), {"part"}).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = join_tables(spark, folder, joined, {"nation", "region"})
    texts = {name: _RAW_TEXT[name]() if name in _RAW_TEXT else ATTRIBUTES[column][1]().cast("string") for name, column in _RAW_FROM.items()}
    return priced(joined).select(*[texts[name].alias(name) for name in RAW_COLUMNS])


def blemished_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`raw_order_lines` with defects."""
    return blemished(raw_order_lines(spark, folder))


def blemished(lines: DataFrame) -> DataFrame:
    """``lines`` of :func:`raw_order_lines` with defects on a fixed share of the rows.

    The rows are all there; order, customer and product numbers decide which
    fields are spoilt, so that a second engine can spoil the same ones.
    """
    order, customer, product = (F.col(c).cast("long") for c in ("Order ID", "Customer ID", "Product ID"))
    quantity = F.col("Quantity").cast("int")

    def spoilt(name: str, condition: Column, value) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(condition, value).otherwise(F.col(name))

    changed = {
        "Sales": spoilt("Sales", order % 97 == 0, None),
        "Profit": spoilt("Profit", order % 89 == 1, "n/a"),
        "Quantity": F.when(order % 101 == 2, (-quantity).cast("string")).otherwise(F.col("Quantity")),
        "Discount": spoilt("Discount", order % 103 == 3, "1.5"),
        "Order Date": spoilt("Order Date", order % 107 == 4, F.date_format(F.to_date("Order Date"), "MM/dd/yyyy")),
        "Customer Name": F.when(customer % 11 == 0, F.lit(None)).otherwise(
            F.concat(F.lit(" \t"), F.col("Customer Name"), F.lit("  "))),
        "Segment": spoilt("Segment", customer % 13 == 1, None),
        "Country": F.when(customer % 17 == 0, F.lit(" USA")).when(customer % 17 == 1, F.lit(None)).otherwise(F.col("Country")),
        "Region": F.when(customer % 19 == 0, F.lit(" w ")).when(customer % 19 == 1, F.lit(None)).otherwise(F.col("Region")),
        "State": spoilt("State", customer % 23 == 0, None),
        "City": spoilt("City", customer % 29 == 0, None),
        "Postal Code": F.when(customer % 7 == 0, F.lit(None)).when(
            customer % 7 == 1, F.concat(F.col("Postal Code"), F.lit(".0"))).otherwise(F.col("Postal Code")),
        "Category": F.when(product % 5 == 0, F.lit(" TECH")).when(product % 5 == 1, F.lit("officesupplies")).otherwise(F.col("Category")),
        "Sub-Category": spoilt("Sub-Category", product % 31 == 0, None),
    }
    return lines.withColumns(changed).select(*RAW_COLUMNS)
