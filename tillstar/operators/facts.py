"""Resolving the surrogate keys of order lines and building fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.schemas import FACT_REJECTS, FACT_SALES
from tillstar.session import materialize

_MEASURES = {
    "Sales": "sales", "Quantity": "quantity", "Discount": "discount", "Profit": "profit",
    "Revenue": "revenue", "Profit_Margin": "profit_margin",
}
FAR_FUTURE = "9999-12-31"


def versions_as_of(wanted: DataFrame, versions: DataFrame) -> DataFrame:
    """``customer_id, day, customer_key, _from, _to``: the version valid on each wanted day of a customer, if any.

    Days and versions are put in one order and the last version is carried forward, so orders and versions of a customer never
    multiply. Only distinct days are sorted: a customer with very many orders has few of them.
    """
    version = F.struct("customer_key", F.col("effective_date").alias("_from"), F.coalesce("expiry_date", F.lit(FAR_FUTURE).cast("date")).alias("_to"))
    starts = versions.where("effective_date IS NOT NULL").select("customer_id", F.col("effective_date").alias("day"), version.alias("_version"))
    days = wanted.where("customer_id IS NOT NULL AND day IS NOT NULL").distinct().withColumn("_version", F.lit(None).cast(starts.schema["_version"].dataType))
    # A version counts from its own first day, so it stands before the day asked for.
    in_time = Window.partitionBy("customer_id").orderBy("day", F.col("_version").isNull(), "_version").rowsBetween(Window.unboundedPreceding, 0)
    carried = days.withColumn("_asked", F.lit(True)).unionByName(starts.withColumn("_asked", F.lit(False))).withColumn("_found", F.last("_version", True).over(in_time))
    valid = F.col("day") <= F.col("_found._to")
    return carried.where("_asked").select("customer_id", "day", F.when(valid, F.col("_found")).alias("_found")).select("customer_id", "day", "_found.*")


def _lost_ids(lines: DataFrame, tables: dict[str, DataFrame], resolve: str) -> list[tuple[DataFrame, dict[str, str]]]:
    """The ids of products and customers (``as_of``: with the day) on the lines that have no row to refer to, and the line columns they stand for."""
    def missing(known: DataFrame, named: dict[str, str]) -> DataFrame:
        return lines.select(*[F.col(c).alias(n) for c, n in named.items()]).na.drop().distinct().join(known, list(named.values()), "left_anti")

    product, customer = {"Product ID": "_lost_product"}, {"Customer ID": "_lost_customer"}
    found = [(missing(tables["dim_product"].select(F.col("product_id").alias("_lost_product")), product), product)]
    if resolve == "current":
        known = tables["dim_customer"].filter("is_current").select(F.col("customer_id").alias("_lost_customer"))
    else:
        customer = {**customer, "Order Date": "_lost_day"}
        asked = lines.select(F.col("Customer ID").alias("customer_id"), F.col("Order Date").alias("day"))
        known = versions_as_of(asked, tables["dim_customer"]).where("customer_key IS NOT NULL").select(
            F.col("customer_id").alias("_lost_customer"), F.col("day").alias("_lost_day"))
    return [(materialize(df), named) for df, named in [*found, (missing(known, customer), customer)]]


def _thinned(lines: DataFrame, lost: list[tuple[DataFrame, dict[str, str]]], unknown: Column, columns: list[str]) -> DataFrame:
    """``lines`` with ``columns`` only where a line is ``unknown`` already or its product or customer is going to be; ``_lost`` says where."""
    for i, (ids, named) in enumerate(lost):
        for column in named:
            unknown = unknown | F.col(f"`{column}`").isNull()
        if not ids.isEmpty():
            same = [F.col(f"`{c}`") == F.col(n) for c, n in named.items()]
            lines = lines.join(ids.withColumn(f"_lost_{i}", F.lit(True)), same, "left").drop(*named.values())
            unknown = unknown | F.col(f"_lost_{i}").isNotNull()
    lines = lines.withColumn("_lost", unknown)
    return lines.withColumns({c: F.when(F.col("_lost"), F.col(f"`{c}`")) for c in columns})


def _customer_lookup(lines: DataFrame, customers: DataFrame, resolve: str) -> DataFrame:
    if resolve == "current":
        known = customers.filter("is_current").select("customer_key", F.col("customer_id").alias("_customer_id"))
        return lines.join(known, F.col("Customer ID") == F.col("_customer_id"), "left")
    if resolve == "as_of":
        known = versions_as_of(lines.select(F.col("Customer ID").alias("customer_id"), F.col("Order Date").alias("day")), customers)
        known = known.withColumnsRenamed({"customer_id": "_customer_id", "day": "_day"})
        return lines.join(known, (F.col("Customer ID") == F.col("_customer_id")) & (F.col("Order Date") == F.col("_day")), "left")
    raise ValueError(f"resolve must be 'current' or 'as_of', not {resolve!r}")


def _region_lookup(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Exact place first, then the first region of the same city whatever its postal code."""
    names = {"Country": "country", "State": "state", "City": "city"}
    exact = regions.select(F.col("region_key").alias("_exact_key"), *[F.col(n).alias(f"_e_{n}") for n in names.values()],
                           F.col("postal_code").alias("_e_postal"))
    fallback = regions.groupBy(*[F.col(n).alias(f"_f_{n}") for n in names.values()]).agg(F.min("region_key").alias("_city_key"))

    def same(prefix: str) -> Column:
        tests = [F.col(c) == F.col(f"{prefix}{n}") for c, n in names.items()]
        return tests[0] & tests[1] & tests[2]

    return (
        lines.join(exact, same("_e_") & (F.col("Postal Code") == F.col("_e_postal")), "left")
        .join(fallback, same("_f_"), "left")
        .withColumn("region_key", F.coalesce("_exact_key", "_city_key"))
    )


def _day_lookup(lines: DataFrame, calendar: DataFrame, key: str, found: str) -> DataFrame:
    days = calendar.select(F.col("date_key").alias(f"_{found}"), F.lit(True).alias(found))
    return lines.join(days, F.col(key) == F.col(f"_{found}"), "left")


def resolve_keys(batch: DataFrame, tables: dict[str, DataFrame], resolve: str = "current", thin: bool = False) -> DataFrame:
    """``batch`` with the five surrogate keys and ``reject_reason``, NULL if all were found.

    Left joins on the natural keys; Spark broadcasts the dimensions whose size
    allows it and splits the partitions of keys that hold very many lines. With ``thin``, what only :func:`reject_rows` reads is NULL on
    the other lines before they are shuffled to the products and customers.
    """
    lines = batch.withColumns({
        "order_date_key": dates.date_key(F.col("Order Date")),
        "ship_date_key": dates.date_key(F.col("Ship Date")),
    })
    lines = _day_lookup(lines, tables["dim_date"], "order_date_key", "_order_day")
    lines = _day_lookup(lines, tables["dim_date"], "ship_date_key", "_ship_day")
    categories = tables["dim_category"].select(
        "category_key", F.col("category_name").alias("_category"), F.col("sub_category").alias("_sub_category"))
    lines = lines.join(categories, (F.col("Category") == F.col("_category")) & (F.col("Sub-Category") == F.col("_sub_category")), "left")
    lines = _region_lookup(lines, tables["dim_region"])
    if thin:
        unknown = F.col("_order_day").isNull() | F.col("_ship_day").isNull() | F.col("region_key").isNull() | F.col("category_key").isNull()
        joined = ("Product ID", "Customer ID", "Order Date")
        texts = [c for c in _REJECTED.values() if c in batch.columns and c not in _MEASURES and c not in ("Order ID", *joined)]
        lines = _thinned(lines, _lost_ids(batch, tables, resolve), unknown, texts)
    products = tables["dim_product"].select("product_key", F.col("product_id").alias("_product_id"))
    lines = lines.join(products, F.col("Product ID") == F.col("_product_id"), "left")
    if thin:
        lines = lines.withColumn("Product ID", F.when(F.col("_lost"), F.col("Product ID")))
    lines = _customer_lookup(lines, tables["dim_customer"], resolve)
    reason = (
        F.when(F.col("_order_day").isNull(), "order date")
        .when(F.col("_ship_day").isNull(), "ship date")
        .when(F.col("customer_key").isNull(), "customer")
        .when(F.col("product_key").isNull(), "product")
        .when(F.col("region_key").isNull(), "region")
        .when(F.col("category_key").isNull(), "category")
    )
    keys = ["order_date_key", "ship_date_key", "customer_key", "product_key", "region_key", "category_key"]
    return lines.select(*[F.col(f"`{c}`") for c in batch.columns], *keys, reason.alias("reject_reason"))


def rejected_lines(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("reject_reason").isNotNull())


def fact_rows(resolved: DataFrame) -> DataFrame:
    """Fact columns of the resolved lines, still without ``sales_key``."""
    found = resolved.filter(F.col("reject_reason").isNull())
    named = found.withColumnsRenamed({**_MEASURES, "Order ID": "order_id", "Ship Mode": "ship_mode"})
    now = F.current_timestamp()
    full = named.withColumns({"created_at": now, "updated_at": now, "order_year": F.year("Order Date")})
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SALES.fields if f.name != "sales_key"])


_REJECTED = {
    "row_id": "Row ID", "order_id": "Order ID", "order_date": "Order Date", "ship_date": "Ship Date", "customer_id": "Customer ID",
    "product_id": "Product ID", "category_name": "Category", "sub_category": "Sub-Category", "country": "Country", "state": "State",
    "city": "City", "postal_code": "Postal Code", "sales": "Sales", "quantity": "Quantity", "discount": "Discount", "profit": "Profit",
}


def kept_of(resolved: DataFrame) -> DataFrame:
    """``resolved`` as :func:`fact_rows` and :func:`reject_rows` read it: what only the latter do is there on rejected lines alone, whether thinned before or not."""
    facts = {*_MEASURES, *_MEASURES.values(), "Order ID", "Ship Mode", "Order Date", *[f.name for f in FACT_SALES.fields], "reject_reason"}
    rejected = F.col("reject_reason").isNotNull()
    shown = {c: F.col(f"`{c}`") if c in facts else F.when(rejected, F.col(f"`{c}`")) for c in resolved.columns if c in facts or c in _REJECTED.values()}
    return resolved.select(*[value.alias(c) for c, value in shown.items()])


def reject_rows(resolved: DataFrame, load: str) -> DataFrame:
    """The rejected lines with their natural keys and amounts, to be kept with the name of the ``load``."""
    given = {name: F.col(f"`{c}`") if c in resolved.columns else F.lit(None) for name, c in _REJECTED.items()}
    own = {"load": F.lit(load), "reject_reason": F.col("reject_reason"), "rejected_at": F.current_timestamp()}
    return rejected_lines(resolved).select(*[{**given, **own}[f.name].cast(f.dataType).alias(f.name) for f in FACT_REJECTS.fields])


def years_of(rows: DataFrame) -> list[int]:
    """The order years of a batch, a few literals by which the stored facts are pruned."""
    return sorted(r[0] for r in rows.select("order_year").distinct().collect())


def without_loaded(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Leave out lines whose (order, product) is in ``facts``, so that a batch may be repeated.

    The product is compared by its stable key. Give only the facts of :func:`years_of` the rows.
    """
    loaded = facts.select("order_id", "product_key", "order_year")
    return rows.join(loaded, ["order_id", "product_key", "order_year"], "left_anti")


def with_sales_keys(rows: DataFrame, largest: int) -> DataFrame:
    """Unique ``sales_key`` after ``largest``, given as the rows are written.

    The keys leave gaps, which spares a sort of all order lines.
    """
    keyed = rows.withColumn("sales_key", F.monotonically_increasing_id() + F.lit(largest + 1))
    return keyed.select(*[f.name for f in FACT_SALES.fields])
