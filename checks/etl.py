"""Cleaning, features, quality checks, dimensions, SCD-2 and facts."""

from __future__ import annotations

import csv
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.sql_parts import LINES, big, dollars, ratio
from tillstar.functions import dates, numbers, text
from tillstar.operators import clean, dedup, dimensions, facts, features, quality, quantiles, scd2
from tillstar.plans.load import load_all, load_customers, load_dimensions, load_facts, run_daily, stage
from tillstar.schemas import REJECTS, STAGING_CLEAN, STAGING_RAW, TABLES, staged_name
from tillstar.session import materialize, scratch_root, store_rows
from tillstar.sources import commerce
from tillstar.sources.files import detect_encodings, extraction_metrics, malformed_rows, read_raw
from tillstar.sources.store import Store, table_counts

# --- the same defects in SQL -------------------------------------------------


def amount(cents: str) -> str:
    return (f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END || CAST(abs({cents}) // 100 AS VARCHAR) || '.' "
            f"|| lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0'))")


INTACT = f"""intact AS (SELECT line_id AS "Row ID", order_id AS "Order ID", strftime(order_date, '%Y-%m-%d') AS "Order Date",
  strftime(ship_date, '%Y-%m-%d') AS "Ship Date", ship_mode AS "Ship Mode", customer_id AS "Customer ID",
  customer_name AS "Customer Name", segment AS "Segment", country AS "Country", city AS "City", state AS "State",
  postal_code AS "Postal Code", region AS "Region", product_id AS "Product ID", category_name AS "Category",
  sub_category AS "Sub-Category", product_name AS "Product Name", {amount('sales_c')} AS "Sales",
  CAST(quantity AS VARCHAR) AS "Quantity", {amount('discount_c')} AS "Discount", {amount('profit_c')} AS "Profit",
  l_orderkey AS o, customer_key AS c, product_key AS p, order_date AS od FROM lines)"""
RAW = """raw AS (SELECT "Row ID", "Order ID",
  CASE WHEN o % 107 = 4 THEN strftime(od, '%m/%d/%Y') ELSE "Order Date" END AS "Order Date", "Ship Date", "Ship Mode", "Customer ID",
  CASE WHEN c % 11 = 0 THEN NULL ELSE ' ' || chr(9) || "Customer Name" || '  ' END AS "Customer Name",
  CASE WHEN c % 13 = 1 THEN NULL ELSE "Segment" END AS "Segment",
  CASE WHEN c % 17 = 0 THEN ' USA' WHEN c % 17 = 1 THEN NULL ELSE "Country" END AS "Country",
  CASE WHEN c % 29 = 0 THEN NULL ELSE "City" END AS "City", CASE WHEN c % 23 = 0 THEN NULL ELSE "State" END AS "State",
  CASE WHEN c % 7 = 0 THEN NULL WHEN c % 7 = 1 THEN "Postal Code" || '.0' ELSE "Postal Code" END AS "Postal Code",
  CASE WHEN c % 19 = 0 THEN ' w ' WHEN c % 19 = 1 THEN NULL ELSE "Region" END AS "Region", "Product ID",
  CASE WHEN p % 5 = 0 THEN ' TECH' WHEN p % 5 = 1 THEN 'officesupplies' ELSE "Category" END AS "Category",
  CASE WHEN p % 31 = 0 THEN NULL ELSE "Sub-Category" END AS "Sub-Category", "Product Name",
  CASE WHEN o % 97 = 0 THEN NULL ELSE "Sales" END AS "Sales",
  CASE WHEN o % 101 = 2 THEN '-' || "Quantity" ELSE "Quantity" END AS "Quantity",
  CASE WHEN o % 103 = 3 THEN '1.5' ELSE "Discount" END AS "Discount",
  CASE WHEN o % 89 = 1 THEN 'n/a' ELSE "Profit" END AS "Profit" FROM intact)"""
KEEP = '"Row ID", "Order ID", "Ship Mode", "Customer ID", "Product ID", "Category", "Product Name"'


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"


TEXTS = [n for n in dict.fromkeys(commerce.RAW_COLUMNS)]
TRIMMED = "trimmed AS (SELECT " + ", ".join(f'{strip(chr(34) + n + chr(34))} AS "{n}"' for n in TEXTS) + " FROM raw)"
CENTS = """CAST(round(TRY_CAST("Sales" AS DOUBLE) * 100) AS BIGINT) AS sales_c, CAST(TRY_CAST("Quantity" AS DOUBLE) AS INTEGER) AS q,
  CAST(round(TRY_CAST("Discount" AS DOUBLE) * 100) AS BIGINT) AS discount_c, CAST(round(TRY_CAST("Profit" AS DOUBLE) * 100) AS BIGINT) AS profit_c,
  CAST(TRY_STRPTIME("Order Date", '%Y-%m-%d') AS DATE) AS od, CAST(TRY_STRPTIME("Ship Date", '%Y-%m-%d') AS DATE) AS sd,
  COALESCE(regexp_replace("Postal Code", '\\.0$', ''), 'Unknown') AS postal"""
TYPED = f'typed AS (SELECT {KEEP}, "Customer Name", "Segment", "Country", "City", "State", "Region", "Sub-Category", {CENTS} FROM trimmed)'
FILLED = """COALESCE("Customer Name", 'Unknown Customer') AS "Customer Name", COALESCE("Segment", 'Consumer') AS "Segment",
  COALESCE("Country", 'United States') AS "Country", COALESCE("City", 'Unknown City') AS "City",
  COALESCE("State", 'Unknown State') AS "State", COALESCE("Region", 'Unknown Region') AS "Region",
  COALESCE("Sub-Category", 'Unknown Sub-Category') AS "Sub-Category" """
COMPLETE = f"""complete AS (SELECT {KEEP}, {FILLED}, sales_c, q, discount_c, profit_c, od, sd, postal FROM typed
  WHERE "Order ID" IS NOT NULL AND "Customer ID" IS NOT NULL AND "Product ID" IS NOT NULL AND sales_c IS NOT NULL
  AND q IS NOT NULL AND profit_c IS NOT NULL)"""
FIRSTS = """firsts AS (SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY "Order ID", "Product ID" ORDER BY "Row ID") = 1)"""
CLEAN = "cleaned AS (SELECT * FROM firsts WHERE q > 0 AND discount_c BETWEEN 0 AND 100 AND od <= sd)"


def title(column: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({column}), '[a-z]+|[^a-z]+'), "
            f"lambda x: upper(x[1]) || x[2:]), '')")


CATEGORY = f"""CASE lower("Category") WHEN 'tech' THEN 'Technology' WHEN 'officesupplies' THEN 'Office Supplies' ELSE {title('"Category"')} END"""
REGION = f"""CASE lower("Region") WHEN 'w' THEN 'West' ELSE {title('"Region"')} END"""
COUNTRY = """CASE "Country" WHEN 'USA' THEN 'United States' ELSE "Country" END"""
NAMED = f"""named AS (SELECT * REPLACE ({CATEGORY} AS "Category", {title('"Sub-Category"')} AS "Sub-Category", {REGION} AS "Region",
  {COUNTRY} AS "Country", {title('"State"')} AS "State", {title('"City"')} AS "City") FROM cleaned)"""
AMOUNTS = """amounts AS (SELECT 'sales' AS k, sales_c AS v FROM named UNION ALL SELECT 'quantity', q FROM named
  UNION ALL SELECT 'profit', profit_c FROM named)"""
RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v) - 1 AS i, COUNT(*) OVER (PARTITION BY k) - 1 AS n FROM amounts)"""


def quarter(q: int) -> str:
    """Four times the quarter value, exactly."""
    return (f"(MAX(v) FILTER (i = n * {q} // 4) * (4 - MAX(n) * {q} % 4) "
            f"+ MAX(v) FILTER (i = (n * {q} + 3) // 4) * (MAX(n) * {q} % 4))")


LIMITS = f"limits AS (SELECT k, {quarter(1)} AS q1, {quarter(3)} AS q3 FROM ranked GROUP BY k)"


def outside(value: str, kind: str) -> str:
    low = f"(SELECT 2 * q1 - 3 * (q3 - q1) FROM limits WHERE k = '{kind}')"
    high = f"(SELECT 2 * q3 + 3 * (q3 - q1) FROM limits WHERE k = '{kind}')"
    return f"(8 * {value} < {low} OR 8 * {value} > {high})"


SILVER = f"""silver AS (SELECT *, (sales_c * (100 - discount_c) + 50) // 100 AS revenue_c,
  CASE WHEN sales_c > 0 THEN greatest(-10.0, least(1.0, {ratio('profit_c', 'sales_c', 4)})) ELSE 0 END AS margin,
  CAST(sd - od AS INTEGER) AS days,
  {outside('sales_c', 'sales')} OR {outside('q', 'quantity')} OR {outside('profit_c', 'profit')} AS is_outlier FROM named)"""
STEPS = [LINES.strip(), INTACT, RAW, TRIMMED, TYPED, COMPLETE, FIRSTS, CLEAN, NAMED, AMOUNTS, RANKED, LIMITS, SILVER]


def upto(last: str, body: str, *more: str) -> str:
    end = next(i for i, s in enumerate(STEPS) if s.startswith(f"{last} AS"))
    return "WITH " + ",\n".join([*STEPS[: end + 1], *more]) + "\n" + body


NUMBERS = (f"{dollars('sales_c')} AS \"Sales\", q AS \"Quantity\", {dollars('discount_c')} AS \"Discount\", "
           f"{dollars('profit_c')} AS \"Profit\", od AS \"Order Date\", sd AS \"Ship Date\", postal AS \"Postal Code\"")
PLACES = '"Customer Name", "Segment", "Country", "City", "State", "Region", "Sub-Category"'

# --- stages ------------------------------------------------------------------

_STORED: dict[tuple[str, str, str], tuple[str, object]] = {}


def stored(name: str, build):
    """``build`` as a layer that is written once per application and folder."""
    def get(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, name)
        if key not in _STORED:
            df = build(spark, folder)
            _STORED[key] = (store_rows(df, "zstd"), df.schema)
        path, schema = _STORED[key]
        return spark.read.schema(schema).parquet(path)

    return get


bronze = stored("bronze", commerce.blemished_order_lines)
intact = stored("intact", commerce.raw_order_lines)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with defects, from the intact ones if only those are stored; that spares joining the tables twice."""
    known = {name for app, at, name in _STORED if (app, at) == (spark.sparkContext.applicationId, folder)}
    return commerce.blemished(intact(spark, folder)) if "intact" in known and "bronze" not in known else bronze(spark, folder)


#: Bytes of lines that are not worth making twice.
FEW_BYTES = 1 << 26


def raw_once(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with defects for one reading: those at hand, else made as they are read, because a large copy that only one reader needs would double what it writes."""
    at_hand = any((app, at) == (spark.sparkContext.applicationId, folder) for app, at, _ in _STORED)
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    few = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength() < FEW_BYTES
    return raw(spark, folder) if at_hand or few else commerce.blemished_order_lines(spark, folder)


trimmed = lambda s, d: clean.trim_whitespace(raw(s, d))
typed = lambda s, d: clean.fix_data_types(trimmed(s, d))
complete = lambda s, d: clean.handle_missing_values(typed(s, d))
cleaned = lambda s, d: clean.clean(raw(s, d))
stored_clean = stored("clean", cleaned)
fresh_silver = lambda s, d: features.transform(stored_clean(s, d))
silver = stored("silver", fresh_silver)
# Its readers ask for few columns each, hardly one of them twice, so it is not stored.
intact_silver = lambda s, d: features.engineer_features(features.normalize_regions(
    features.normalize_categories(clean.fix_data_types(intact(s, d)))))


query("x1_trim_whitespace", trimmed, upto("trimmed", "SELECT * FROM trimmed"))
query("x2_x3_x4_fix_data_types", typed, upto("typed", f"SELECT {KEEP}, {PLACES}, {NUMBERS} FROM typed"))
query("x3_dates_in_several_formats", lambda s, d: raw(s, d).select(
    "Row ID", dates.parse_date(F.col("Order Date"), dates.DATE_FORMATS).alias("order_date")),
    upto("raw", """SELECT "Row ID", CAST(COALESCE(TRY_STRPTIME("Order Date", '%Y-%m-%d'), TRY_STRPTIME("Order Date", '%m/%d/%Y')) AS DATE)
  AS order_date FROM raw"""))
query("x17_date_keys", lambda s, d: raw(s, d).select(
    "Row ID", dates.date_key_from_text(F.col("Order Date")).alias("order_date_key")),
    upto("raw", """SELECT "Row ID", CAST(strftime(COALESCE(TRY_STRPTIME("Order Date", '%Y-%m-%d'), TRY_STRPTIME("Order Date", '%m/%d/%Y')),
  '%Y%m%d') AS INTEGER) AS order_date_key FROM raw"""))
query("f2_f3_missing_values", complete, upto("complete", f"SELECT {KEEP}, {PLACES}, {NUMBERS} FROM complete"))
query("w10_first_of_each_key", lambda s, d: dedup.remove_duplicates(complete(s, d)),
      upto("firsts", f"SELECT {KEEP}, {PLACES}, {NUMBERS} FROM firsts"))
query("f1_valid_records", lambda s, d: clean.remove_invalid_records(typed(s, d)), upto("typed", f"""SELECT {KEEP}, {PLACES}, {NUMBERS}
  FROM typed WHERE q > 0 AND discount_c BETWEEN 0 AND 100 AND od <= sd"""))
query("f1_f2_f3_w10_clean", cleaned, upto("cleaned", f"SELECT {KEEP}, {PLACES}, {NUMBERS} FROM cleaned"))
query("x5_to_x10_canonical_names", lambda s, d: features.normalize_regions(features.normalize_categories(cleaned(s, d))),
      upto("named", f"SELECT {KEEP}, {PLACES}, {NUMBERS} FROM named"))
query("q10_x11_to_x14_transform", fresh_silver, upto("silver", f"""SELECT {KEEP}, {PLACES}, {NUMBERS}, is_outlier,
  {dollars('revenue_c')} AS "Revenue", margin AS "Profit_Margin", days AS "Order_to_Ship_Days",
  CAST(year(od) AS INTEGER) AS "Order_Year", CAST(quarter(od) AS INTEGER) AS "Order_Quarter", CAST(month(od) AS INTEGER) AS "Order_Month",
  monthname(od) AS "Order_Month_Name", CAST(isodow(od) - 1 AS INTEGER) AS "Order_Day_of_Week", dayname(od) AS "Order_Day_Name" FROM silver"""))
query("q10_outlier_bounds", lambda s, d: quantiles.outlier_bounds(
    cleaned(s, d).select(*[F.col(c).cast("decimal(18,4)").alias(c.lower()) for c in ("Sales", "Quantity", "Profit")]),
    ("sales", "quantity", "profit")),
    upto("limits", """SELECT k AS column_name,
  CAST(2 * q1 - 3 * (q3 - q1) AS DOUBLE) / (CASE WHEN k = 'quantity' THEN 8 ELSE 800 END) AS lower_bound,
  CAST(2 * q3 + 3 * (q3 - q1) AS DOUBLE) / (CASE WHEN k = 'quantity' THEN 8 ELSE 800 END) AS upper_bound FROM limits"""))

LATER = """SELECT line_id, order_id, l_linenumber,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY line_id) > 1 AS _is_duplicate FROM lines"""


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    return commerce.read(spark, folder, "lineitem").select(
        commerce.line_id().alias("line_id"), F.col("l_orderkey").cast("string").alias("order_id"), "l_linenumber")


query("w9_duplicate_flags", lambda s, d: dedup.flag_duplicates(numbered_lines(s, d), ("order_id", "l_linenumber"), F.col("line_id")),
      f"WITH {LINES.strip()}\n{LATER}")
query("w9_exact_duplicate_flags", lambda s, d: dedup.flag_exact_duplicates(
    commerce.read(s, d, "lineitem").select("l_orderkey", "l_linenumber")),
    """SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS _is_duplicate FROM lineitem""")

# --- quality -----------------------------------------------------------------

TESTS = [
    *[(f"null_check_{c}", "critical", f'"{c}" IS NULL') for c in quality.CRITICAL_COLUMNS],
    *[(f"type_check_{c}_float", "critical", f'"{c}" IS NOT NULL AND TRY_CAST("{c}" AS DOUBLE) IS NULL') for c in ("Sales", "Discount", "Profit")],
    ("type_check_Quantity_int", "critical", 'TRY_CAST("Quantity" AS DOUBLE) IS NULL OR TRY_CAST("Quantity" AS DOUBLE) % 1 <> 0'),
    *[(f"range_check_{c}", "warning", f'TRY_CAST("{c}" AS DOUBLE) < {lo} OR TRY_CAST("{c}" AS DOUBLE) > {hi}')
      for c, (lo, hi) in quality.RANGE_RULES.items()],
    (quality.DATE_RULE, "critical", """TRY_STRPTIME("Order Date", '%Y-%m-%d') > TRY_STRPTIME("Ship Date", '%Y-%m-%d')"""),
]
REPEATED = 'COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM raw GROUP BY {keys} HAVING COUNT(*) > 1) AS g), 0)'


def results_sql(names: tuple[str, ...]) -> str:
    rows = []
    for rule, severity, keys in (("pk_uniqueness_check", "critical", '"Row ID"'),
                                 ("composite_duplicates_check", "warning", '"Order ID", "Product ID"')):
        if rule.startswith(names):
            rows.append(f"SELECT '{rule}' AS rule_name, '{severity}' AS severity, {REPEATED.format(keys=keys)} AS n, COUNT(*) AS t FROM raw")
    rows += [f"SELECT '{r}' AS rule_name, '{s}' AS severity, COUNT(*) FILTER ({t}) AS n, COUNT(*) AS t FROM raw"
             for r, s, t in TESTS if r.startswith(names)]
    return "results AS (" + " UNION ALL ".join(rows) + ")"


def checks_sql(*names: str) -> str:
    return upto("raw", f"""SELECT rule_name, n = 0 AS passed, severity, {big('n')} AS affected_rows, {big('t')} AS total_rows FROM results""",
                results_sql(names or ("",)))


def plain(results: DataFrame) -> DataFrame:
    return results.drop("message", "details")


query("q1_primary_key_check", lambda s, d: plain(quality.check_primary_keys(raw(s, d), ["Row ID"])), checks_sql("pk_"))
query("q2_duplicates_check", lambda s, d: plain(quality.check_duplicates(raw(s, d), ["Order ID", "Product ID"])), checks_sql("composite_"))
query("q3_null_checks", lambda s, d: plain(quality.check_nulls(raw(s, d))), checks_sql("null_"))
query("q4_type_checks", lambda s, d: plain(quality.check_data_types(raw(s, d))), checks_sql("type_"))
query("q5_range_checks", lambda s, d: plain(quality.check_ranges(raw(s, d))), checks_sql("range_"))
query("q6_date_rule_check", lambda s, d: plain(quality.check_business_rules(raw(s, d))), checks_sql("business_"))
query("q1_to_q6_validation", lambda s, d: plain(quality.validate(raw(s, d))), checks_sql())
query("q8_quality_report", lambda s, d: quality.quality_report(quality.validate(raw(s, d)), "raw").drop("timestamp", "results"),
      upto("raw", f"""SELECT 'raw' AS stage, {big('COUNT(*)')} AS total_checks, {big('COUNT(*) FILTER (n = 0)')} AS passed,
  {big("COUNT(*) FILTER (n > 0 AND severity = 'critical')")} AS failed, {big("COUNT(*) FILTER (n > 0 AND severity = 'warning')")} AS warnings,
  CAST(greatest(0, 100 - 15 * COUNT(*) FILTER (n > 0 AND severity = 'critical') - 5 * COUNT(*) FILTER (n > 0 AND severity = 'warning')) AS DOUBLE)
  AS quality_score FROM results""", results_sql(("",))))
query("sc5_extraction_metrics", lambda s, d: extraction_metrics(raw(s, d)).select(
    "row_count", "duplicate_count", "column_count", F.explode("null_counts").alias("entry")).select(
    "row_count", "duplicate_count", "column_count", "entry.column_name", "entry.null_count"),
    upto("raw", f"""SELECT {big('(SELECT COUNT(*) FROM raw)')} AS row_count, {big('0')} AS duplicate_count, CAST(21 AS INTEGER) AS column_count,
  column_name, {big('null_count')} AS null_count FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT(\"{c}\") AS null_count FROM raw" for c in TEXTS) + ") AS n WHERE null_count > 0"))

# --- dimensions --------------------------------------------------------------


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def good_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return dims_from(intact_silver(spark, folder))


def unstamped(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


def dims_from(batch: DataFrame) -> dict[str, DataFrame]:
    """All dimensions as a first load of ``batch`` builds them."""
    spark = batch.sparkSession
    categories = materialize(dimensions.new_categories(empty(spark, "dim_category"), batch))
    return {
        "dim_date": materialize(dimensions.calendar(batch, "Order Date", "Ship Date")),
        "dim_category": categories,
        "dim_region": dimensions.new_regions(empty(spark, "dim_region"), batch),
        "dim_customer": scd2.apply_customers(empty(spark, "dim_customer"), batch)[0],
        "dim_product": dimensions.new_products(empty(spark, "dim_product"), batch, categories),
    }


CALENDAR = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(isodow(d) AS INTEGER) AS day_of_week,
  dayname(d) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend, FALSE AS is_holiday,
  CAST(quarter(d - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter, CAST(year(d - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year"""
query("l1_calendar", lambda s, d: dimensions.calendar(
    commerce.order_lines(s, d, "full_date", "ship_date"), "full_date", "ship_date"),
    f"""SELECT {CALENDAR} FROM (SELECT unnest(generate_series(make_timestamp(lo, 1, 1, 0, 0, 0), make_timestamp(hi, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS d
  FROM (SELECT year(least(min(l_shipdate), (SELECT min(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey))) AS lo,
    year(greatest(max(l_shipdate), (SELECT max(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey))) AS hi FROM lineitem) AS span) AS days""")
CATEGORIES = """categories AS (SELECT row_number() OVER (ORDER BY "Category", "Sub-Category") AS category_key,
  upper("Category"[1:4]) || '-' || upper(replace("Sub-Category", ' ', '')) AS category_id, "Category" AS category_name,
  "Sub-Category" AS sub_category, 'Product Category: ' || "Category" || ', Sub-Category: ' || "Sub-Category" AS description
  FROM (SELECT DISTINCT "Category", "Sub-Category" FROM {source}) AS pairs)"""
REGIONS = """regions AS (SELECT row_number() OVER (ORDER BY country, state, city, postal_code) AS region_key, * FROM (
  SELECT "Country" AS country, "Region" AS region, "State" AS state, "City" AS city, postal AS postal_code FROM {source}
  QUALIFY row_number() OVER (PARTITION BY "Country", "State", "City", postal ORDER BY "Row ID") = 1) AS places)"""
CUSTOMERS = """customers AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM (SELECT "Customer ID" AS customer_id,
  "Customer Name" AS customer_name, "Segment" AS segment, od AS effective_date FROM {source}
  QUALIFY row_number() OVER (PARTITION BY "Customer ID" ORDER BY od DESC, "Row ID" DESC) = 1) AS latest)"""
PRODUCTS = """products AS (SELECT row_number() OVER (ORDER BY product_id) AS product_key, f.product_id, f.product_name, c.category_key,
  f.sub_category FROM (SELECT "Product ID" AS product_id, "Product Name" AS product_name, "Category" AS category, "Sub-Category" AS sub_category
  FROM {source} QUALIFY row_number() OVER (PARTITION BY "Product ID" ORDER BY "Row ID") = 1) AS f
  LEFT JOIN categories c ON c.category_name = f.category AND c.sub_category = f.sub_category)"""
DIMS = tuple(cte.format(source="silver") for cte in (CATEGORIES, REGIONS, CUSTOMERS, PRODUCTS))

query("l2_category_dimension", lambda s, d: unstamped(dimensions.new_categories(empty(s, "dim_category"), silver(s, d))),
      upto("silver", "SELECT * FROM categories", DIMS[0]))
query("l3_region_dimension", lambda s, d: unstamped(dimensions.new_regions(empty(s, "dim_region"), silver(s, d))),
      upto("silver", "SELECT * FROM regions", DIMS[1]))
query("l4_customer_dimension_first_load", lambda s, d: unstamped(scd2.apply_customers(empty(s, "dim_customer"), silver(s, d))[0]),
      upto("silver", "SELECT *, CAST(NULL AS DATE) AS expiry_date, TRUE AS is_current FROM customers", DIMS[2]))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    batch = silver(spark, folder)
    categories = dimensions.new_categories(empty(spark, "dim_category"), batch)
    return unstamped(dimensions.new_products(empty(spark, "dim_product"), batch, categories))


query("l6_product_dimension", _products, upto("silver", "SELECT * FROM products", DIMS[0], DIMS[3]))
query("x23_category_code_collisions", lambda s, d: quality.category_code_collisions(
    dimensions.new_categories(empty(s, "dim_category"), silver(s, d))),
    upto("silver", "SELECT category_id, COUNT(*) AS copies FROM categories GROUP BY category_id HAVING COUNT(*) > 1", DIMS[0]))

SPLIT = "1998-07-01"


def priority_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Customer attributes that really change: the priority of an order stands for the segment."""
    orders = commerce.read(spark, folder, "orders")
    customer = commerce.read(spark, folder, "customer").select("c_custkey", "c_name")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("o_orderpriority").alias("segment"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderkey").cast("string").alias("row_id"))


def two_batches(spark: SparkSession, folder: str, late: bool = False) -> DataFrame:
    changes = priority_changes(spark, folder)
    old, new = changes.filter(F.col("order_date") < SPLIT), changes.filter(F.col("order_date") >= SPLIT)
    if late:
        old, new = new, old

    def step(existing, batch):
        return scd2.scd2_apply_batch(existing, batch, "customer_id", ("customer_name", "segment"), "order_date",
                                     scd2.latest_first(batch), "customer_key")[0]

    return step(materialize(step(empty(spark, "dim_customer"), old)), new)


CHANGES = """changes AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, o_orderpriority AS segment,
  CAST(o_orderdate AS DATE) AS order_date, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey)"""
HISTORY = """daily AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY customer_id, order_date ORDER BY o_orderkey DESC) = 1),
starts AS (SELECT * FROM (SELECT *, lag(segment) OVER w AS s0, lag(customer_name) OVER w AS n0 FROM daily
  WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)) AS g WHERE s0 IS DISTINCT FROM segment OR n0 IS DISTINCT FROM customer_name),
history AS (SELECT customer_id, customer_name, segment, order_date AS effective_date, CAST(lead(order_date) OVER w - 1 AS DATE) AS expiry_date,
  lead(order_date) OVER w IS NULL AS is_current FROM starts WINDOW w AS (PARTITION BY customer_id ORDER BY order_date))"""
BATCHES = f"""old AS (SELECT * FROM changes WHERE order_date < DATE '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, o_orderkey DESC) = 1),
new AS (SELECT * FROM changes WHERE order_date >= DATE '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, o_orderkey DESC) = 1),
v1 AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM old),
added AS (SELECT row_number() OVER (ORDER BY new.customer_id) + (SELECT MAX(customer_key) FROM v1) AS customer_key, new.*
  FROM new LEFT JOIN v1 USING (customer_id) WHERE v1.customer_key IS NULL OR v1.segment <> new.segment OR v1.customer_name <> new.customer_name)"""
query("l4_scd2_two_batches", lambda s, d: unstamped(two_batches(s, d)), f"""WITH {CHANGES}, {BATCHES}
SELECT v1.customer_key, v1.customer_id, v1.customer_name, v1.segment, v1.order_date AS effective_date,
  CAST(added.order_date - 1 AS DATE) AS expiry_date, added.customer_id IS NULL AS is_current FROM v1 LEFT JOIN added USING (customer_id)
UNION ALL SELECT customer_key, customer_id, customer_name, segment, order_date, NULL, TRUE FROM added""")
INVERTED = f"""SELECT 'scd2_inverted_interval' AS rule_name, n = 0 AS passed, 'warning' AS severity, {big('n')} AS affected_rows,
  {big('(SELECT COUNT(*) FROM v1) + (SELECT COUNT(*) FROM added)')} AS total_rows
  FROM (SELECT COUNT(*) AS n FROM v1 JOIN added USING (customer_id) WHERE added.order_date - 1 < v1.order_date) AS bad"""
query("q7_scd2_inverted_versions", lambda s, d: plain(quality.inverted_versions(two_batches(s, d))), f"WITH {CHANGES}, {BATCHES} {INVERTED}")
query("q7_scd2_inverted_versions_late", lambda s, d: plain(quality.inverted_versions(two_batches(s, d, late=True))),
      f"WITH {CHANGES}, {BATCHES.replace('old AS', 'older AS').replace('new AS', 'old AS', 1).replace('older AS', 'new AS', 1)} {INVERTED}")


def late_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The customer versions after three loads: the newest days first, then older ones that interleave."""
    changes = priority_changes(spark, folder).withColumnsRenamed({
        "customer_id": "Customer ID", "customer_name": "Customer Name", "segment": "Segment", "order_date": "Order Date", "row_id": "Row ID"})
    old, odd = F.col("Order Date") < SPLIT, F.col("Row ID").cast("bigint") % 2 == 1
    store = Store(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}")
    store.create_tables()
    for batch in (changes.where(~old), changes.where(old & odd), changes.where(old & ~odd)):
        load = store.load()
        load_customers(load, batch, daily=True)
        load.commit()
    return scd2.collapsed(store.read("dim_customer"), "customer_id", ("customer_name", "segment"))


query("l4_scd2_late_batches", late_batches, f"WITH {CHANGES}, {HISTORY} SELECT * FROM history")


def history(spark: SparkSession, folder: str) -> DataFrame:
    changes = priority_changes(spark, folder)
    return scd2.scd2_history(changes, "customer_id", ("customer_name", "segment"), "order_date", scd2.latest_first(changes)[1:])


query("l5_scd2_history", history, f"WITH {CHANGES}, {HISTORY} SELECT * FROM history")


def orders_as_of(spark: SparkSession, folder: str) -> DataFrame:
    versions = history(spark, folder).withColumn("customer_key", F.xxhash64("customer_id", "effective_date"))
    orders = commerce.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").cast("string").alias("Customer ID"),
        F.to_date("o_orderdate").alias("Order Date"))
    matched = facts._customer_lookup(orders, versions, "as_of")
    return matched.select("order_key", F.col("Customer ID").alias("customer_id"), F.col("_from").alias("effective_date"))


query("j10_orders_as_of_version", orders_as_of, f"""WITH {CHANGES}, {HISTORY}
SELECT o_orderkey AS order_key, c.customer_id, effective_date FROM changes c LEFT JOIN history h ON h.customer_id = c.customer_id
  AND c.order_date BETWEEN h.effective_date AND COALESCE(h.expiry_date, DATE '9999-12-31')""")

# --- facts -------------------------------------------------------------------

FACT_SHOWN = ("order_id", "order_date_key", "ship_date_key", "customer_key", "product_key", "region_key", "category_key",
              "ship_mode", "sales", "quantity", "discount", "profit", "revenue", "profit_margin", "order_year")


def loaded_facts(spark: SparkSession, folder: str) -> DataFrame:
    batch = silver(spark, folder)
    return facts.fact_rows(facts.resolve_keys(batch, dims_from(batch))).select(*FACT_SHOWN)


query("l7_facts", loaded_facts, upto("silver", f"""SELECT s."Order ID" AS order_id, CAST(strftime(od, '%Y%m%d') AS INTEGER) AS order_date_key,
  CAST(strftime(sd, '%Y%m%d') AS INTEGER) AS ship_date_key, customer_key, product_key, region_key, c.category_key, "Ship Mode" AS ship_mode,
  {dollars('sales_c')} AS sales, q AS quantity, {dollars('discount_c')} AS discount, {dollars('profit_c')} AS profit,
  {dollars('revenue_c')} AS revenue, margin AS profit_margin, CAST(year(od) AS INTEGER) AS order_year
  FROM silver s JOIN customers u ON u.customer_id = s."Customer ID" JOIN products p ON p.product_id = s."Product ID"
  JOIN regions r ON r.country = s."Country" AND r.state = s."State" AND r.city = s."City" AND r.postal_code = s.postal
  JOIN categories c ON c.category_name = s."Category" AND c.sub_category = s."Sub-Category" """, *DIMS))

# Dimensions of the intact lines, lines with defects: fallbacks and rejects occur.
GOOD = f"""good AS (SELECT "Row ID", "Customer ID", "Customer Name", "Segment", "Product ID", "Product Name", "Country",
  {title('"Region"')} AS "Region", {title('"State"')} AS "State", {title('"City"')} AS "City", "Postal Code" AS postal,
  {title('"Category"')} AS "Category", {title('"Sub-Category"')} AS "Sub-Category", od FROM intact)"""
GOOD_DIMS = (GOOD, *[cte.format(source="good") for cte in (CATEGORIES, REGIONS, CUSTOMERS, PRODUCTS)])
FALLBACK = """cities AS (SELECT country, state, city, MIN(region_key) AS city_key FROM regions GROUP BY ALL),
resolved AS (SELECT s."Row ID" AS line_id, u.customer_key, p.product_key, c.category_key, COALESCE(r.region_key, t.city_key) AS region_key,
  CASE WHEN u.customer_key IS NULL THEN 'customer' WHEN p.product_key IS NULL THEN 'product'
    WHEN COALESCE(r.region_key, t.city_key) IS NULL THEN 'region' WHEN c.category_key IS NULL THEN 'category' END AS reject_reason
  FROM silver s LEFT JOIN customers u ON u.customer_id = s."Customer ID" LEFT JOIN products p ON p.product_id = s."Product ID"
  LEFT JOIN regions r ON r.country = s."Country" AND r.state = s."State" AND r.city = s."City" AND r.postal_code = s.postal
  LEFT JOIN cities t ON t.country = s."Country" AND t.state = s."State" AND t.city = s."City"
  LEFT JOIN categories c ON c.category_name = s."Category" AND c.sub_category = s."Sub-Category")"""


def resolved_lines(spark: SparkSession, folder: str) -> DataFrame:
    dims = good_dims(spark, folder)
    return facts.resolve_keys(silver(spark, folder), dims).select(
        F.col("Row ID").alias("line_id"), "customer_key", "product_key", "category_key", "region_key", "reject_reason")


query("j5_j6_key_resolution", resolved_lines, upto("silver", "SELECT * FROM resolved", *GOOD_DIMS, FALLBACK))
query("j7_rejected_lines", lambda s, d: facts.rejected_lines(resolved_lines(s, d)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines")),
      upto("silver", f"SELECT reject_reason, {big('COUNT(*)')} AS lines FROM resolved WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
           *GOOD_DIMS, FALLBACK))
def integrity(spark: SparkSession, folder: str) -> DataFrame:
    dims = good_dims(spark, folder)
    return plain(quality.referential_integrity(
        silver(spark, folder), dims["dim_customer"], dims["dim_product"], dims["dim_region"]))


query("q7_j9_referential_integrity", integrity,
    upto("silver", f"""SELECT rule_name, n = 0 AS passed, 'critical' AS severity, {big('n')} AS affected_rows,
  {big('(SELECT COUNT(*) FROM silver)')} AS total_rows FROM (
  SELECT 'ref_integrity_customer_id' AS rule_name, COUNT(DISTINCT "Customer ID") FILTER ("Customer ID" NOT IN (SELECT customer_id FROM customers)) AS n FROM silver
  UNION ALL SELECT 'ref_integrity_product_id', COUNT(DISTINCT "Product ID") FILTER ("Product ID" NOT IN (SELECT product_id FROM products)) FROM silver
  UNION ALL SELECT 'ref_integrity_region_country_state_city', COUNT(*) FROM (SELECT DISTINCT "Country" AS country, "State" AS state, "City" AS city
    FROM silver EXCEPT SELECT country, state, city FROM regions) AS missing) AS found""", *GOOD_DIMS))


def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after loading the lines twice; the second load must add nothing."""
    store = Store(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}")
    store.create_tables()
    batch = silver(spark, folder)
    load_all(store, batch, idempotent=True)
    load_all(store, batch, idempotent=True)
    return table_counts(store.tables())


query("l8_a20_table_counts_after_load", load_counts, upto("silver", f"""SELECT 'dim_date' AS table_name,
  {big("(SELECT make_date(year(greatest(max(od), max(sd))), 12, 31) - make_date(year(least(min(od), min(sd))), 1, 1) + 1 FROM silver)")} AS row_count
  UNION ALL SELECT 'dim_category', {big('COUNT(*)')} FROM categories UNION ALL SELECT 'dim_region', {big('COUNT(*)')} FROM regions
  UNION ALL SELECT 'dim_customer', {big('COUNT(*)')} FROM customers UNION ALL SELECT 'dim_product', {big('COUNT(*)')} FROM products
  UNION ALL SELECT 'fact_sales', {big('COUNT(*)')} FROM silver""", *DIMS))

def committed(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of the facts after two named loads, the first one repeated, and one that ended before its commit."""
    store = Store(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}")
    store.create_tables()
    batch = silver(spark, folder)
    old, new = batch.where(F.col("Order Date") < SPLIT), batch.where(F.col("Order Date") >= SPLIT)
    for name, rows in (("older", old), ("newer", new), ("older", old)):
        load_all(store, rows, name=name)
    broken = store.load("broken")
    load_dimensions(broken, batch)
    return store.parts().where("table_name = 'fact_sales'").select("load", "version", "rows", "first_year", "last_year")


query("l7_committed_batches", committed, upto("silver", f"""SELECT CASE WHEN od < DATE '{SPLIT}' THEN 'older' ELSE 'newer' END AS load, CAST(1 AS INTEGER) AS version,
  {big('COUNT(*)')} AS rows, CAST(min(year(od)) AS INTEGER) AS first_year, CAST(max(year(od)) AS INTEGER) AS last_year FROM silver GROUP BY 1"""))


def stored_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a load of lines with defects rejects where the dimensions are those of the intact lines."""
    store = Store(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}")
    store.create_tables()
    known = store.load("dimensions")
    load_dimensions(known, intact_silver(spark, folder))
    known.commit()
    lines = store.load("lines")
    load_facts(lines, silver(spark, folder))
    lines.commit()
    return store.read(REJECTS).select("load", F.col("row_id").alias("line_id"), "reject_reason", "customer_id", "product_id")


query("j7_stored_rejects", stored_rejects, upto("silver", """SELECT 'lines' AS load, line_id, reject_reason, s."Customer ID" AS customer_id, s."Product ID" AS product_id
  FROM resolved JOIN silver s ON s."Row ID" = line_id WHERE reject_reason IS NOT NULL""", *GOOD_DIMS, FALLBACK))

def staged(table: str):
    def get(spark: SparkSession, folder: str) -> DataFrame:
        store = Store(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}")
        stage(store, raw(spark, folder), silver(spark, folder))
        return store.read(table)

    return get


query("sk6_staging_raw", staged(STAGING_RAW), upto("raw", "SELECT " + ", ".join(f'"{c}" AS {staged_name(c)}' for c in TEXTS) + " FROM raw"))
query("sk6_staging_clean", lambda s, d: staged(STAGING_CLEAN)(s, d).select("row_id", "order_date", "ship_date", "customer_name", "postal_code", "sales", "quantity", "discount", "profit", "revenue", "profit_margin"),
      upto("silver", f"""SELECT "Row ID" AS row_id, od AS order_date, sd AS ship_date, "Customer Name" AS customer_name, postal AS postal_code, {dollars('sales_c')} AS sales,
  q AS quantity, {dollars('discount_c')} AS discount, {dollars('profit_c')} AS profit, {dollars('revenue_c')} AS revenue, margin AS profit_margin FROM silver"""))
query("x23_collisions_in_a_run", lambda s, d: plain(quality.shared_category_codes(dimensions.new_categories(empty(s, "dim_category"), silver(s, d)))),
      upto("silver", f"""SELECT 'category_code_collision' AS rule_name, n = 0 AS passed, 'warning' AS severity, {big('n')} AS affected_rows, {big('(SELECT COUNT(*) FROM categories)')} AS total_rows
  FROM (SELECT COALESCE(SUM(c), 0) AS n FROM (SELECT COUNT(*) AS c FROM categories GROUP BY category_id HAVING COUNT(*) > 1) AS g) AS found""", DIMS[0]))

# --- files and the whole run --------------------------------------------------


def _joined(rows: DataFrame) -> bool:
    return "Join" in rows._jdf.queryExecution().optimizedPlan().toString()


def csv_files(rows: DataFrame, path: str, files: int | None = None, reverse: bool = False) -> None:
    """``rows`` as files like those of Python's csv module, ``files`` of them or at least three unless the rows come from a join; a row whose ``_fields`` is set gets one field more or one less.

    The lines are made where the rows are read, and a task writes its lines as they come, so files may be of any size.
    """
    names = [c for c in rows.columns if c != "_fields"][:: -1 if reverse else 1]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="").writerow(names)
    head = pa.RecordBatch.from_arrays([pa.array([out.getvalue()])], ["value"])

    def joined(fields: list[str]):
        values = F.array(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in fields])
        special = lambda v: v.contains('"') | v.contains(",") | v.contains("\n") | v.contains("\r")
        quoted = F.transform(values, lambda v: F.when(special(v), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v))
        # Most rows have nothing to quote; the commas and the rest of the plain line tell.
        plain = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in fields])
        commas = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(","), F.lit("")))
        hard = plain.contains('"') | plain.contains("\n") | plain.contains("\r") | (commas >= len(fields))
        return F.when(hard, F.array_join(quoted, ",")).otherwise(plain)

    def headed(batches):
        yield head
        yield from (pa.RecordBatch.from_arrays(batch.columns, ["value"]) for batch in batches)

    line = joined(names)
    if "_fields" in rows.columns:
        line = F.when(F.col("_fields") == "less", joined(names[:-1])).otherwise(F.concat(line, F.when(F.col("_fields") == "more", ",surplus").otherwise("")))
    lines = rows.select(line.alias("value"))
    # Rows that are still to be joined come in as many tasks as the join has; to count these would join them twice.
    if files or (not _joined(lines) and lines.rdd.getNumPartitions() < 3):
        lines = lines.repartition(files or 3)
    lines.mapInArrow(headed, "value string").write.option("lineSep", "\r\n").mode("append").text(path)


def landing(name: str, write):
    """What ``write`` puts into a folder as files of order lines, once per application and folder of tables."""
    written: dict[tuple[str, str], str] = {}

    def get(spark: SparkSession, folder: str) -> str:
        key = (spark.sparkContext.applicationId, folder)
        if key not in written:
            path = f"{scratch_root(spark)}/landing-{name}-{uuid.uuid4().hex}"
            write(spark, folder, path)
            written[key] = path
        return written[key]

    return get


landed = landing("orders", lambda s, d, path: csv_files(raw_once(s, d), path))
query("sc1_sc3_sc4_csv_scan", lambda s, d: read_raw(s, landed(s, d), null_words=("",)), upto("raw", "SELECT * FROM raw"))


def hostile(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes, commas and line breaks in a field, null words, one field too many or too few."""
    n = F.split_part(F.col("`Row ID`"), F.lit("-"), F.lit(1)).cast("bigint")
    name = F.when(n % 7 == 0, F.concat(F.lit('"A", '), F.col("`Product Name`"), F.lit('\nsecond "line"'))).otherwise(F.col("`Product Name`"))
    country = F.when(n % 11 == 0, "NULL").when(n % 11 == 1, "n/a").otherwise(F.col("`Country`"))
    fields = F.when(n % 50 == 0, "more").when(n % 50 == 1, "less")
    return raw_once(spark, folder).withColumns({"Product Name": name, "Country": country, "_fields": fields})


WORDS = "('n/a', 'N/A', 'NA', 'NULL', 'null', 'nan', 'NaN', 'None', '')"
HOSTILE = f"""SELECT CASE WHEN COLUMNS(*) NOT IN {WORDS} THEN COLUMNS(*) END FROM (SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 7 = 0 THEN '"A", ' || "Product Name" || chr(10) || 'second "line"' ELSE "Product Name" END AS "Product Name",
  CASE WHEN n % 11 > 1 THEN "Country" END AS "Country", CASE WHEN n % 50 <> 1 THEN "Profit" END AS "Profit")
  FROM (SELECT *, CAST(split_part("Row ID", '-', 1) AS BIGINT) AS n FROM raw) AS numbered WHERE n % 50 <> 0) AS told"""
hostile_landed = landing("hostile", lambda s, d, path: csv_files(hostile(s, d), path))
query("sc1_hostile_files", lambda s, d: read_raw(s, hostile_landed(s, d)), upto("raw", HOSTILE))
query("sc1_malformed_rows", lambda s, d: malformed_rows(s, hostile_landed(s, d)).select(
    F.count(F.lit(1)).alias("malformed"), F.count_if(F.col("record").endswith(",surplus")).alias("with_surplus")),
    upto("raw", """SELECT COUNT(*) AS malformed, COUNT(*) AS with_surplus FROM raw WHERE CAST(split_part("Row ID", '-', 1) AS BIGINT) % 50 = 0"""))


def mixed_files(spark: SparkSession, folder: str, path: str, files: int | None = 2) -> None:
    """Files in two encodings, with the columns in two orders and one column that only some have; ``files`` of each, or as many as tasks read the rows."""
    rows = raw(spark, folder)
    n = F.split_part(F.col("`Row ID`"), F.lit("-"), F.lit(1)).cast("bigint")
    rows = rows.withColumn("Customer Name", F.concat(F.lit("Zoë "), F.col("`Customer Name`")))
    csv_files(rows.where(n % 2 == 0), path, files, reverse=True)
    late = rows.where(n % 2 == 1).withColumn("Note", F.lit("late"))
    late = late.repartition(files) if files else late
    late.write.options(header=True, encoding="iso-8859-1", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).mode("append").csv(path)


mixed_folder = landing("mixed", mixed_files)
wide_folder = landing("wide", lambda s, d, path: mixed_files(s, d, path, None))
query("sc3_mixed_headers", lambda s, d: read_raw(s, wide_folder(s, d), null_words=("",)), upto("raw", """SELECT * REPLACE ('Zoë ' || "Customer Name" AS "Customer Name"),
  CASE WHEN CAST(split_part("Row ID", '-', 1) AS BIGINT) % 2 = 1 THEN 'late' END AS "Note" FROM raw"""))
query("sc4_file_encodings", lambda s, d: detect_encodings(s, mixed_folder(s, d)).groupBy("encoding").agg(F.count(F.lit(1)).alias("files")),
      "SELECT 'utf-8' AS encoding, CAST(2 AS BIGINT) AS files UNION ALL SELECT 'iso-8859-1', 2")


def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    work = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    result = run_daily(spark, landed(spark, folder), work, null_words=("",))
    return result.as_row(spark).select(
        "status", "rows_extracted", "rows_cleaned", "rows_transformed", "rows_loaded", "rows_rejected",
        "raw_quality_score", "transformed_quality_score")


SCORE = """CAST(greatest(0, 100 - 15 * COUNT(*) FILTER (n > 0 AND severity = 'critical') - 5 * COUNT(*) FILTER (n > 0 AND severity = 'warning')) AS DOUBLE)"""
query("l10_l12_daily_run", run_counts, upto("silver", f"""SELECT 'QUALITY_FAILURE' AS status, {big('(SELECT COUNT(*) FROM raw)')} AS rows_extracted,
  {big('(SELECT COUNT(*) FROM cleaned)')} AS rows_cleaned, {big('(SELECT COUNT(*) FROM silver)')} AS rows_transformed,
  {big('(SELECT COUNT(*) FROM silver)')} AS rows_loaded, {big('(SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM cleaned)')} AS rows_rejected,
  {SCORE} AS raw_quality_score,
  CAST(100 - 5 * (SELECT CAST(COUNT(*) FILTER (sales_c > 10000000) > 0 AS INTEGER) + CAST(COUNT(*) FILTER (profit_c < -2000000 OR profit_c > 5000000) > 0 AS INTEGER)
    FROM silver) AS DOUBLE) AS transformed_quality_score FROM results""", results_sql(("",))))

# --- scalar helpers over whole tables ----------------------------------------

query("x18_hash_keys", lambda s, d: commerce.read(s, d, "lineitem").select(
    text.hash_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), digits=16).alias("hash_key"),
    text.hash_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("full_key")),
    "SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey))[1:16] AS hash_key, sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey)) AS full_key FROM lineitem")
query("x19_x26_formats", lambda s, d: commerce.read(s, d, "customer").select(
    "c_custkey", numbers.format_currency(F.col("c_acctbal").cast("decimal(12,2)")).alias("balance"),
    numbers.format_percent((F.col("c_custkey") % 1000) / 1000).alias("share")),
    """SELECT c_custkey, format('${:,.2f}', CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE)) AS balance,
  format('{:.1f}%', (c_custkey % 1000) / 10.0) AS share FROM customer""")
query("x26_date_format", lambda s, d: commerce.read(s, d, "orders").select("o_orderkey", dates.format_date(F.col("o_orderdate")).alias("shown")),
      "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS shown FROM orders")
query("x20_clean_strings", lambda s, d: raw(s, d).select("Row ID", text.clean_string(F.col("Customer Name")).alias("customer_name")),
      upto("raw", f"""SELECT "Row ID", NULLIF({strip('"Customer Name"')}, '') AS customer_name FROM raw"""))
query("x21_x22_safe_divide", lambda s, d: commerce.order_lines(s, d, "sales_key", "sales", "discount").select(
    "sales_key", numbers.safe_divide(F.col("sales"), F.col("discount")).alias("quotient")),
    f"""WITH {LINES.strip()} SELECT line_id AS sales_key, CASE WHEN discount_c = 0 THEN 0.0::DOUBLE
  ELSE ({dollars('sales_c')}) / ({dollars('discount_c')}) END AS quotient FROM lines""")
