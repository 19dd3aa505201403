"""Lookups, pages, dashboard data sets, roles, and joins with the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.etl import DIMS, silver, upto
from checks.registry import ORACLES, query, star_query
from checks.sql_parts import AOV, MARGIN, ORDERS, SRP, big, dollars, ratio, totals, with_lines
from tillstar.operators import dimensions
from tillstar.plans import analytics, reads, reports
from tillstar.plans.load import load_all
from tillstar.plans.star import SlicedStar, SourceStar, WarehouseStar, join_date, secured
from tillstar.plans.summaries import MONTHS, distinct_estimates, distinct_sketches, refresh_changed, refresh_summaries
from tillstar.session import scratch_root
from tillstar.sources import commerce
from tillstar.sources.store import Store

SEGMENT, CATEGORY, REGION = "MACHINERY", "PROMO", "AMERICA"
START, END = dt.date(1996, 3, 1), dt.date(1999, 10, 31)
ROLES = {"Asia Manager": "ASIA", "America Manager": "AMERICA", "Africa Manager": "AFRICA"}

star_query("r1_kpi_card", reads.kpis, with_lines(
    f"""SELECT {totals('revenue total_sales', 'profit total_profit')}, {big(ORDERS)} AS total_orders, {AOV} AS avg_order_value,
  {MARGIN} AS profit_margin, {big('COUNT(DISTINCT customer_key)')} AS total_customers FROM lines"""))
CUSTOMER = """SELECT c_custkey AS customer_key, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
  c_mktsegment AS segment, TRUE AS is_current FROM customer"""
star_query("r2_f8_customers", reads.customers, CUSTOMER)
star_query("r2_t3_customer_page", lambda s: reads.page(reads.customers(s, SEGMENT), [F.desc("customer_key")], 2, 20),
           f"{CUSTOMER} WHERE c_mktsegment = '{SEGMENT}' ORDER BY c_custkey DESC LIMIT 20 OFFSET 20")
star_query("t3_customer_page_info", lambda s: reads.page_info(reads.customers(s, SEGMENT), 2, 20),
           f"""SELECT COUNT(*) AS total, 2 AS page, 20 AS page_size, CAST(ceil(COUNT(*) / 20.0) AS BIGINT) AS total_pages
  FROM customer WHERE c_mktsegment = '{SEGMENT}'""")
star_query("f10_customer_by_id", lambda s: reads.customer(s, "77"), f"{CUSTOMER} WHERE c_custkey = 77")
PRODUCT = """SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS sub_category,
  p_type AS category_name FROM part"""
star_query("r3_j4_products", reads.products, PRODUCT)
star_query("r3_t3_product_page", lambda s: reads.page(reads.products(s, CATEGORY), [F.desc("product_key")], 3, 15),
           f"{PRODUCT} WHERE p_type = '{CATEGORY}' ORDER BY p_partkey DESC LIMIT 15 OFFSET 30")
star_query("f10_product_by_id", lambda s: reads.product(s, "42"), f"{PRODUCT} WHERE p_partkey = 42")
LINE = f"""SELECT line_id AS sales_key, order_id, {dollars('sales_c')} AS sales, quantity, {dollars('discount_c')} AS discount,
  {dollars('profit_c')} AS profit, {dollars('revenue_c')} AS revenue,
  CASE WHEN sales_c > 0 THEN greatest(-10.0, least(1.0, {ratio('profit_c', 'sales_c', 4)})) ELSE 0 END AS profit_margin,
  order_date, ship_date, customer_name, product_name, region, category_name AS category FROM lines"""
WHERE = f"""WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}' AND region = '{REGION}' AND category_name = '{CATEGORY}' AND sales_c >= 5000000"""
star_query("r4_f13_sales_lines", reads.sales_lines, with_lines(LINE))
star_query("r4_f4_f5_f6_sales_lines_filtered", lambda s: reads.sales_lines(s, START, END, REGION, CATEGORY, 50000),
           with_lines(f"{LINE} {WHERE}"))
star_query("r4_t3_sales_page", lambda s: reads.page(reads.sales_lines(s, START, END, REGION, CATEGORY, 50000), [F.desc("sales_key")], 2, 20),
           with_lines(f"{LINE} {WHERE} ORDER BY sales_key DESC LIMIT 20 OFFSET 20"))
star_query("t3_sales_page_after_key", lambda s: reads.page_after(reads.sales_lines(s), "sales_key", "3", 25),
           with_lines(f"{LINE} WHERE line_id < '3' ORDER BY sales_key DESC LIMIT 25"))

SALES_PROFIT = totals("revenue sales", "profit profit")
DASHBOARD = {
    "kpis": f"""SELECT {totals('revenue total_sales', 'profit total_profit')}, {big(ORDERS)} AS total_orders, {AOV} AS avg_order_value,
  {MARGIN} AS profit_margin, {big('COUNT(DISTINCT customer_key)')} AS total_customers FROM lines""",
    "sales_by_category": f"SELECT category_name AS category, {SALES_PROFIT} FROM lines GROUP BY category_name",
    "sales_by_region": f"SELECT region, {SALES_PROFIT} FROM lines GROUP BY region",
    "monthly_trend": f"SELECT year, month, month_name, {SALES_PROFIT}, {big(ORDERS)} AS orders FROM lines GROUP BY year, month, month_name",
    "top_products": f"""SELECT product_id, product_name, category_name AS category, {SALES_PROFIT} FROM lines
  GROUP BY product_id, product_name, category_name, sub_category ORDER BY SUM(revenue_c) DESC, product_id LIMIT 5""",
}
for name, sql in DASHBOARD.items():
    star_query(f"r5_a15_dashboard_{name}", lambda s, n=name: reads.dashboard(s)[n], with_lines(sql))

star_query("f11_region_of_role", lambda s: analytics.regional_performance(secured(s, "Asia Manager", ROLES)), with_lines(
    f"""SELECT region, country, state, {SRP}, {big(ORDERS)} AS total_orders, {MARGIN} AS profit_margin
  FROM lines WHERE region = 'ASIA' GROUP BY region, country, state"""))


def sliced(star):
    return SlicedStar(star, year=1998, region=REGION, segment=SEGMENT)


SLICE = f"WHERE year = 1998 AND region = '{REGION}' AND segment = '{SEGMENT}'"
REV_PROFIT = totals("revenue total_revenue", "profit total_profit")
star_query("a26_f4_trend_of_slice", lambda s: reports.monthly_trend(sliced(s)), with_lines(
    f"SELECT year, month, month_name, {REV_PROFIT} FROM lines {SLICE} GROUP BY year, month, month_name"))
star_query("a26_f4_categories_of_slice", lambda s: reports.category_split(sliced(s)), with_lines(
    f"SELECT category_name, {REV_PROFIT} FROM lines {SLICE} GROUP BY category_name"))
star_query("a26_region_split", reports.region_split, with_lines(f"SELECT region, {REV_PROFIT} FROM lines GROUP BY region"))

# --- joins with the calendar table -------------------------------------------


def dated_facts(spark, folder):
    star = SourceStar(spark, folder)
    facts = star.lines("order_date_key", "ship_date_key", "order_year", "revenue")
    days = dimensions.calendar(commerce.order_lines(spark, folder, "full_date", "ship_date"), "full_date", "ship_date")
    return facts, days


def by_fiscal_quarter(spark, folder):
    facts, days = dated_facts(spark, folder)
    return join_date(facts, days).groupBy("fiscal_year", "fiscal_quarter").agg(F.sum("revenue").alias("total_revenue"))


def order_and_ship_quarters(spark, folder):
    """The calendar in two roles: quarter of the order and quarter of the shipment."""
    facts, days = dated_facts(spark, folder)
    ordered = days.select("date_key", "year", F.col("quarter").alias("order_quarter"))
    shipped = days.select("date_key", F.col("year").alias("ship_year"), F.col("quarter").alias("ship_quarter"))
    joined = join_date(join_date(facts, ordered).drop("date_key"), shipped, "ship_date_key")
    return joined.groupBy(F.col("year").alias("order_year"), "order_quarter", "ship_year", "ship_quarter").agg(
        F.sum("revenue").alias("total_revenue"))


def by_ship_month(spark, folder):
    facts, days = dated_facts(spark, folder)
    return join_date(facts, days, "ship_date_key").groupBy("year", "month").agg(F.sum("revenue").alias("total_revenue"))


query("j1_fiscal_quarters", by_fiscal_quarter, with_lines(
    f"""SELECT CAST(year(order_date - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, CAST(quarter(order_date - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter,
  {totals('revenue total_revenue')} FROM lines GROUP BY ALL"""))
query("j3_order_and_ship_quarters", order_and_ship_quarters, with_lines(
    f"""SELECT year AS order_year, quarter AS order_quarter, CAST(year(ship_date) AS INTEGER) AS ship_year,
  CAST(quarter(ship_date) AS INTEGER) AS ship_quarter, {totals('revenue total_revenue')} FROM lines GROUP BY ALL"""))
query("j11_ship_months", by_ship_month, with_lines(
    f"""SELECT CAST(year(ship_date) AS INTEGER) AS year, CAST(month(ship_date) AS INTEGER) AS month, {totals('revenue total_revenue')}
  FROM lines GROUP BY ALL"""))

# --- the stored star ---------------------------------------------------------

_LOADED: dict[tuple[str, str], str] = {}


def loaded_star(spark, folder) -> WarehouseStar:
    """The star after loading the cleaned lines into tables, once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LOADED:
        root = f"{scratch_root(spark)}/warehouse-{abs(hash(key))}"
        store = Store(spark, root)
        store.create_tables()
        load_all(store, silver(spark, folder), idempotent=True)
        _LOADED[key] = root
    return WarehouseStar(Store(spark, _LOADED[key]).tables())


SILVER_SUMS = f"""{dollars('SUM(sales_c)')} AS total_sales, {dollars('SUM(revenue_c)')} AS total_revenue, {dollars('SUM(profit_c)')} AS total_profit"""
SILVER_ORDERS = 'COUNT(DISTINCT "Order ID")'
query("sc6_a1_stored_revenue_by_month", lambda s, d: analytics.revenue_by_month(loaded_star(s, d)), upto("silver",
    f"""SELECT CAST(year(od) AS INTEGER) AS year, CAST(month(od) AS INTEGER) AS month, monthname(od) AS month_name, {SILVER_SUMS},
  {big('SUM(q)')} AS total_quantity, {big(SILVER_ORDERS)} AS total_orders,
  {ratio('SUM(revenue_c)', f'({SILVER_ORDERS} * 100)', 2)} AS average_order_value, {MARGIN} AS profit_margin FROM silver GROUP BY ALL"""))
query("sc6_j2_stored_profitability_by_region", lambda s, d: analytics.profitability_analysis(loaded_star(s, d), "region"), upto("silver",
    f"""SELECT r.region, r.state, r.city, {SILVER_SUMS}, {MARGIN} AS profit_margin FROM silver s
  JOIN regions r ON r.country = s."Country" AND r.state = s."State" AND r.city = s."City" AND r.postal_code = s.postal
  GROUP BY r.region, r.state, r.city""", DIMS[1]))
query("sc6_j2_stored_profitability_by_category", lambda s, d: analytics.profitability_analysis(loaded_star(s, d)), upto("silver",
    f"""SELECT "Category" AS category_name, "Ship Mode" AS ship_mode, {SILVER_SUMS}, {MARGIN} AS profit_margin FROM silver GROUP BY ALL"""))
query("sc6_a8_stored_kpis", lambda s, d: analytics.get_kpis(loaded_star(s, d)), upto("silver",
    f"""SELECT {dollars('SUM(sales_c)')} AS gross_sales, {dollars('SUM(revenue_c)')} AS net_revenue, {dollars('SUM(profit_c)')} AS total_profit,
  {big('SUM(q)')} AS total_quantity, {big(SILVER_ORDERS)} AS total_orders, {big('COUNT(DISTINCT "Customer ID")')} AS total_customers,
  {ratio('SUM(revenue_c)', f'({SILVER_ORDERS} * 100)', 2)} AS average_order_value, {MARGIN} AS net_profit_margin FROM silver"""))


def refreshed(name):
    """A summary as its refresh stores it."""
    def get(spark, folder):
        star = loaded_star(spark, folder)
        return refresh_summaries(Store(spark, _LOADED[(spark.sparkContext.applicationId, folder)]), star, [name])[name]

    return get


query("l9_refreshed_monthly_sales", refreshed("mv_monthly_sales"), upto("silver",
    f"""SELECT CAST(year(od) AS INTEGER) AS year, CAST(month(od) AS INTEGER) AS month, monthname(od) AS month_name, "Category" AS category_name,
  {SILVER_SUMS}, {big('SUM(q)')} AS total_quantity, {big(SILVER_ORDERS)} AS total_orders FROM silver GROUP BY ALL"""))
query("l9_refreshed_product_performance", refreshed("mv_product_performance"), upto("silver",
    f"""SELECT p.product_key, p.product_id, p.product_name, s."Category" AS category_name, p.sub_category, {SILVER_SUMS},
  {big('SUM(q)')} AS total_quantity FROM silver s JOIN products p ON p.product_id = s."Product ID" GROUP BY ALL""", DIMS[0], DIMS[3]))
query("l9_refreshed_customer_summary", refreshed("mv_customer_summary"), upto("silver",
    f"""SELECT c.customer_key, c.customer_id, c.customer_name, c.segment, {dollars('SUM(sales_c)')} AS lifetime_sales, {dollars('SUM(revenue_c)')} AS lifetime_revenue,
  {dollars('SUM(profit_c)')} AS lifetime_profit, {big(SILVER_ORDERS)} AS total_orders, MAX(od) AS last_order_date
  FROM silver s JOIN customers c ON c.customer_id = s."Customer ID" GROUP BY ALL""", DIMS[2]))

_LATE: dict[tuple[str, str], str] = {}


def late_month(name):
    """A summary after a load of all lines but those of one month, a refresh, a load of that month, and a refresh that computes it alone."""
    def get(spark, folder):
        key = (spark.sparkContext.applicationId, folder)
        if key not in _LATE:
            store = Store(spark, f"{scratch_root(spark)}/late-{abs(hash(key))}")
            store.create_tables()
            late = F.col("Order Date").between("1997-03-01", "1997-03-31")
            for rows, months in ((silver(spark, folder).where(~late), None), (silver(spark, folder).where(late), [199703])):
                load_all(store, rows)
                computed = refresh_changed(store)
                if computed != dict.fromkeys(MONTHS, months):
                    raise ValueError(f"refreshed {computed}")
            _LATE[key] = store.root
        return Store(spark, _LATE[key]).read(name)

    return get


query("l9_late_month_of_monthly_sales", late_month("mv_monthly_sales"), ORACLES["l9_refreshed_monthly_sales"])
query("l9_late_month_of_product_performance", lambda s, d: late_month("mv_product_performance")(s, d).drop("product_key"),
      f"SELECT * EXCLUDE (product_key) FROM ({ORACLES['l9_refreshed_product_performance']}) AS whole")
query("a16_approximate_distinct", lambda s, d: distinct_estimates(distinct_sketches(SourceStar(s, d)), ("year",)).join(
    SourceStar(s, d).order_totals(("year", "customer_key")).groupBy("year").agg(F.count_distinct("order_id").alias("o"), F.count_distinct("customer_key").alias("c")), "year").select(
    "year", F.col("o").alias("orders"), F.col("c").alias("customers"),
    (F.abs(F.col("approx_orders") - F.col("o")) <= 0.05 * F.col("o")).alias("orders_close"),
    (F.abs(F.col("approx_customers") - F.col("c")) <= 0.05 * F.col("c")).alias("customers_close")),
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(DISTINCT o_orderkey) AS orders, COUNT(DISTINCT o_custkey) AS customers, TRUE AS orders_close, TRUE AS customers_close
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
