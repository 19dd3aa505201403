"""Column names and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of an order-line file, in file order.
RAW_COLUMNS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode",
    "Customer ID", "Customer Name", "Segment",
    "Country", "City", "State", "Postal Code", "Region",
    "Product ID", "Category", "Sub-Category", "Product Name",
    "Sales", "Quantity", "Discount", "Profit",
)


# Everything is read as text, so that codes keep their leading zeros.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

INT, LONG, TEXT, DATE, FLAG, TIME = T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.BooleanType(), T.TimestampType()
MONEY, DISCOUNT, MARGIN = T.DecimalType(12, 2), T.DecimalType(5, 2), T.DecimalType(6, 4)

# Column names and order of the stored tables.
DIM_DATE = T.StructType([
    T.StructField("date_key", INT),
    T.StructField("full_date", DATE),
    T.StructField("day_of_week", INT),
    T.StructField("day_name", TEXT),
    T.StructField("day_of_month", INT),
    T.StructField("day_of_year", INT),
    T.StructField("week_of_year", INT),
    T.StructField("month", INT),
    T.StructField("month_name", TEXT),
    T.StructField("quarter", INT),
    T.StructField("year", INT),
    T.StructField("is_weekend", FLAG),
    T.StructField("is_holiday", FLAG),
    T.StructField("fiscal_quarter", INT),
    T.StructField("fiscal_year", INT),
])
DIM_CATEGORY = T.StructType([
    T.StructField("category_key", LONG),
    T.StructField("category_id", TEXT),
    T.StructField("category_name", TEXT),
    T.StructField("sub_category", TEXT),
    T.StructField("description", TEXT),
    T.StructField("created_at", TIME),
    T.StructField("updated_at", TIME),
])
DIM_REGION = T.StructType([
    T.StructField("region_key", LONG),
    T.StructField("country", TEXT),
    T.StructField("region", TEXT),
    T.StructField("state", TEXT),
    T.StructField("city", TEXT),
    T.StructField("postal_code", TEXT),
    T.StructField("created_at", TIME),
    T.StructField("updated_at", TIME),
])
DIM_PRODUCT = T.StructType([
    T.StructField("product_key", LONG),
    T.StructField("product_id", TEXT),
    T.StructField("product_name", TEXT),
    T.StructField("category_key", LONG),
    T.StructField("sub_category", TEXT),
    T.StructField("created_at", TIME),
    T.StructField("updated_at", TIME),
])
DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", LONG),
    T.StructField("customer_id", TEXT),
    T.StructField("customer_name", TEXT),
    T.StructField("segment", TEXT),
    T.StructField("effective_date", DATE),
    T.StructField("expiry_date", DATE),
    T.StructField("is_current", FLAG),
    T.StructField("created_at", TIME),
    T.StructField("updated_at", TIME),
])
FACT_SALES = T.StructType([
    T.StructField("sales_key", LONG),
    T.StructField("order_id", TEXT),
    T.StructField("order_date_key", INT),
    T.StructField("ship_date_key", INT),
    T.StructField("customer_key", LONG),
    T.StructField("product_key", LONG),
    T.StructField("region_key", LONG),
    T.StructField("category_key", LONG),
    T.StructField("ship_mode", TEXT),
    T.StructField("sales", MONEY),
    T.StructField("quantity", INT),
    T.StructField("discount", DISCOUNT),
    T.StructField("profit", MONEY),
    T.StructField("revenue", MONEY),
    T.StructField("profit_margin", MARGIN),
    T.StructField("created_at", TIME),
    T.StructField("updated_at", TIME),
    T.StructField("order_year", INT),
])


def staged_name(column: str) -> str:
    return column.lower().replace(" ", "_").replace("-", "_")


# Names of the staging tables. The raw one holds the file's texts, the clean one typed columns with revenue and margin.
STAGING_RAW, STAGING_CLEAN = "stg_raw_sales", "stg_clean_sales"
_TYPED = {"order_date": DATE, "ship_date": DATE, "sales": MONEY, "quantity": INT, "discount": DISCOUNT, "profit": MONEY}
STAGING = {
    STAGING_RAW: T.StructType([T.StructField(staged_name(c), TEXT) for c in RAW_COLUMNS]),
    STAGING_CLEAN: T.StructType([*[T.StructField(staged_name(c), _TYPED.get(staged_name(c), TEXT)) for c in RAW_COLUMNS],
                                 T.StructField("revenue", MONEY), T.StructField("profit_margin", MARGIN)]),
}
#: Lines that a load could not resolve, with the load's name and the reason.
FACT_REJECTS = T.StructType([
    T.StructField("load", TEXT),
    T.StructField("reject_reason", TEXT),
    T.StructField("row_id", TEXT),
    T.StructField("order_id", TEXT),
    T.StructField("order_date", DATE),
    T.StructField("ship_date", DATE),
    T.StructField("customer_id", TEXT),
    T.StructField("product_id", TEXT),
    T.StructField("category_name", TEXT),
    T.StructField("sub_category", TEXT),
    T.StructField("country", TEXT),
    T.StructField("state", TEXT),
    T.StructField("city", TEXT),
    T.StructField("postal_code", TEXT),
    T.StructField("sales", MONEY),
    T.StructField("quantity", INT),
    T.StructField("discount", DISCOUNT),
    T.StructField("profit", MONEY),
    T.StructField("rejected_at", TIME),
])
#: A customer version as it is stored: also the days on which it was seen, each with the id of the row that told it.
CUSTOMER_HISTORY = T.StructType([*DIM_CUSTOMER.fields, T.StructField("seen", T.ArrayType(T.StructType([
    T.StructField("day", DATE), T.StructField("row", TEXT)])))])

FACTS, REJECTS = "fact_sales", "fact_rejects"
TABLES = {
    "dim_date": DIM_DATE,
    "dim_category": DIM_CATEGORY,
    "dim_region": DIM_REGION,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    FACTS: FACT_SALES,
}
STORED = {**TABLES, REJECTS: FACT_REJECTS, **STAGING}
