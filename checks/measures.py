"""Business measures, reports and summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query, star_query
from checks.sql_parts import AVG_DISCOUNT, MARGIN, ORDERS, SRP, big, dollars, totals, with_lines
from tillstar.plans import forecast, measures, reports, summaries
from tillstar.sources import commerce
from tillstar.sources.store import changed_partitions

YEARS = tuple(range(1995, 2002))


def share(num: str, den: str) -> str:
    """Quotient of two doubles, 0 where undefined."""
    return f"COALESCE(({num}) / NULLIF({den}, 0), 0)"


def money(measure: str) -> str:
    return f"({dollars(f'SUM({measure}_c)')})"


def measure_sql(by: str) -> str:
    shown = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return with_lines(f"""SELECT {shown}{money('sales')} AS gross_sales, CAST(SUM(sales_c * discount_c) AS DOUBLE) / 10000 AS discount_amount,
  {money('revenue')} AS revenue, {dollars('(SUM(revenue_c) - SUM(profit_c))')} AS cost, {money('profit')} AS profit,
  {share(money('profit'), money('revenue'))} AS profit_margin, {share(money('revenue'), f'CAST({ORDERS} AS DOUBLE)')} AS average_order_value,
  {share(money('sales'), 'CAST(SUM(quantity) AS DOUBLE)')} AS average_unit_price, {big(ORDERS)} AS orders,
  {big('SUM(quantity)')} AS units, {big('COUNT(DISTINCT customer_key)')} AS customers,
  {share(money('revenue'), 'CAST(COUNT(DISTINCT customer_key) AS DOUBLE)')} AS revenue_per_customer,
  {share(dollars('SUM(discount_c)'), 'CAST(COUNT(*) AS DOUBLE)')} AS average_discount,
  {share('CAST(SUM(ship_date - order_date) AS DOUBLE)', 'CAST(COUNT(*) AS DOUBLE)')} AS average_shipping_days
  FROM lines {group}""")


star_query("m1_to_m14_m22_measures", lambda s: measures.measure_table(s, ()), measure_sql(""))
star_query("m1_to_m14_m22_measures_by_segment_and_year", lambda s: measures.measure_table(s, ("segment", "year")), measure_sql("segment, year"))
star_query("m1_to_m14_m22_measures_by_category", lambda s: measures.measure_table(s, ("category_name",)), measure_sql("category_name"))
star_query("m13_active_customer_ratio", measures.active_customer_ratio, with_lines(
    f"""SELECT {share("CAST((SELECT COUNT(DISTINCT customer_key) FROM lines WHERE sales_c > 0) AS DOUBLE)",
                      "CAST((SELECT COUNT(DISTINCT c_custkey) FROM customer) AS DOUBLE)")} AS active_customer_ratio"""))

DAYS = "days AS (SELECT order_date AS full_date, SUM(revenue_c) AS rev FROM lines GROUP BY order_date)"


def running(parts: str) -> str:
    return dollars(f"SUM(rev) OVER (PARTITION BY {parts} ORDER BY full_date ROWS UNBOUNDED PRECEDING)")


star_query("m15_m16_m17_to_date_revenue", measures.to_date_revenue, with_lines(
    f"""SELECT full_date, {dollars('rev')} AS revenue, {running('year(full_date), month(full_date)')} AS revenue_mtd,
  {running('year(full_date), quarter(full_date)')} AS revenue_qtd, {running('year(full_date)')} AS revenue_ytd FROM days""", DAYS))
star_query("m18_m19_year_over_year", measures.year_over_year, with_lines(
    f"""SELECT d.full_date, {dollars('d.rev')} AS revenue, {dollars('p.rev')} AS prior_year_revenue,
  {share(f"({dollars('(d.rev - p.rev)')})", f"({dollars('p.rev')})")} AS yoy_growth
  FROM days d LEFT JOIN days p ON p.full_date = CAST(d.full_date - INTERVAL 1 YEAR AS DATE)""", DAYS))
MONTHS = "months AS (SELECT year, quarter, month, SUM(revenue_c) AS rev FROM lines GROUP BY ALL)"
star_query("m20_m21_month_over_month", measures.month_over_month, with_lines(
    f"""SELECT m.year, m.month, {dollars('m.rev')} AS revenue, {dollars('p.rev')} AS prior_month_revenue,
  {share(f"({dollars('(m.rev - p.rev)')})", f"({dollars('p.rev')})")} AS mom_growth
  FROM months m LEFT JOIN months p ON p.year * 12 + p.month = m.year * 12 + m.month - 1""", MONTHS))
star_query("m23_product_rank", measures.product_rank, with_lines(
    f"""SELECT product_id, {money('revenue')} AS revenue, CAST(RANK() OVER (ORDER BY SUM(revenue_c) DESC) AS BIGINT) AS product_sales_rank
  FROM lines GROUP BY product_id"""))
star_query("m24_lifetime_value", measures.lifetime_value, with_lines(
    f"SELECT customer_id, {money('revenue')} AS lifetime_value FROM lines GROUP BY customer_id"))
star_query("m25_retention", measures.retention, with_lines(
    f"""SELECT year, {big('here')} AS current_customers, {big('prior')} AS prior_customers, {big('kept')} AS retained_customers,
  {share('CAST(kept AS DOUBLE)', 'CAST(prior AS DOUBLE)')} AS retention_rate FROM (
  SELECT year, COUNT(*) AS here, (SELECT COUNT(*) FROM active p WHERE p.year = a.year - 1) AS prior,
    (SELECT COUNT(*) FROM active c JOIN active p USING (customer_key) WHERE c.year = a.year AND p.year = a.year - 1) AS kept
  FROM active a GROUP BY year) AS y""", "active AS (SELECT DISTINCT year, customer_key FROM lines)"))
star_query("u1_returning_customers", lambda s: measures.returning_customers(s, 1998), with_lines(
    "SELECT customer_key FROM lines WHERE year = 1998 INTERSECT SELECT customer_key FROM lines WHERE year = 1997"))
star_query("m26_revenue_forecast", forecast.revenue_forecast, with_lines(
    """SELECT series, make_date(CAST((last + h) // 12 AS INTEGER), CAST((last + h) % 12 + 1 AS INTEGER), 1) AS month_start,
  round(center, 2) AS forecast, round(center - width, 2) AS lower_bound, round(center + width, 2) AS upper_bound FROM (
  SELECT *, level + h * trend + terms[(n + h - 1) % 12 + 1] AS center, 1.959963984540054::DOUBLE * sqrt(squares / n) * sqrt(1 + (h - 1) * 0.3::DOUBLE * 0.3::DOUBLE) AS width
  FROM ended, (SELECT unnest(range(1, 7)) AS h) AS ahead) AS told""",
    "summed AS (SELECT category_name AS series, year * 12 + month - 1 AS m, CAST(SUM(revenue_c) AS DOUBLE) / 100 AS v FROM lines GROUP BY ALL)",
    "spans AS (SELECT series, min(m) AS first, max(m) AS last FROM summed GROUP BY series)",
    """filled AS (SELECT g.series, g.last, g.m - g.first AS i, coalesce(s.v, 0) AS v
  FROM (SELECT series, first, last, unnest(range(first, last + 1)) AS m FROM spans) AS g LEFT JOIN summed s ON s.series = g.series AND s.m = g.m)""",
    "firsts AS (SELECT series, last, avg(v) AS start, list(v ORDER BY i) AS head, (SELECT count(*) FROM filled f WHERE f.series = h.series) AS n FROM filled h WHERE i < 12 GROUP BY series, last)",
    """smooth AS (
  SELECT series, last, n, CAST(0 AS BIGINT) AS i, start AS level, CAST(0 AS DOUBLE) AS trend, list_transform(range(1, 13), lambda k: coalesce(head[k] - start, 0)) AS terms, CAST(0 AS DOUBLE) AS squares FROM firsts
  UNION ALL
  SELECT series, last, n, i + 1, now, 0.05::DOUBLE * (now - level) + 0.95::DOUBLE * trend,
    list_transform(terms, lambda t, k: CASE WHEN k = i % 12 + 1 THEN 0.2::DOUBLE * (v - now) + 0.8::DOUBLE * t ELSE t END),
    squares + (v - (level + trend + terms[i % 12 + 1])) ** 2
  FROM (SELECT s.*, f.v, 0.3::DOUBLE * (f.v - terms[s.i % 12 + 1]) + 0.7::DOUBLE * (level + trend) AS now FROM smooth s JOIN filled f ON f.series = s.series AND f.i = s.i) AS moved)""",
    "ended AS (SELECT * FROM smooth WHERE i = n)").replace("WITH lines", "WITH RECURSIVE lines", 1))

# --- reports -----------------------------------------------------------------

star_query("a21_place_matrix", reports.place_matrix, with_lines(
    f"""SELECT region, state, city, CAST(grouping_id(region, state, city) AS INTEGER) AS level, {totals('revenue total_revenue', 'profit total_profit')},
  {big(ORDERS)} AS total_orders, CAST(SUM(ship_date - order_date) AS DOUBLE) / COUNT(*) AS average_shipping_days
  FROM lines GROUP BY ROLLUP (region, state, city)"""))
PIVOT = ", ".join(
    f"""{dollars(f'SUM(m.rev) FILTER (m.year = {y})')} AS revenue_{y},
  SUM({share(f"({dollars('(m.rev - p.rev)')})", f"({dollars('p.rev')})")}) FILTER (m.year = {y}) AS growth_{y}""" for y in YEARS)
star_query("a22_year_matrix", lambda s: reports.year_matrix(s, YEARS), with_lines(
    f"""SELECT m.quarter, m.month, {PIVOT} FROM months m LEFT JOIN months p ON p.year = m.year - 1 AND p.month = m.month
  GROUP BY m.quarter, m.month""", MONTHS))
star_query("a23_weekday_volume", reports.weekday_volume, with_lines(
    f"""SELECT CAST(isodow(order_date) AS INTEGER) AS day_of_week, dayname(order_date) AS day_name, {totals('revenue total_revenue', 'quantity total_quantity')},
  {big(ORDERS)} AS total_orders FROM lines GROUP BY ALL"""))
star_query("a24_segment_contribution", reports.segment_contribution, with_lines(
    f"""SELECT segment, {money('revenue')} AS total_revenue,
  {share(money('revenue'), f"({dollars('(SELECT SUM(revenue_c) FROM lines)')})")} AS revenue_share FROM lines GROUP BY segment"""))
star_query("a24_segment_trend", reports.segment_trend, with_lines(
    f"SELECT segment, year, month, {totals('revenue total_revenue', 'profit total_profit')} FROM lines GROUP BY segment, year, month"))
star_query("a25_discount_scatter", reports.discount_scatter, with_lines(
    f"""SELECT product_id, product_name, {AVG_DISCOUNT} AS average_discount, {totals('revenue total_revenue', 'quantity total_quantity')},
  {MARGIN} AS profit_margin FROM lines GROUP BY product_id, product_name"""))
star_query("a26_place_map", reports.place_map, with_lines(
    f"SELECT city, state, {totals('revenue total_revenue', 'profit total_profit')}, {MARGIN} AS profit_margin FROM lines GROUP BY city, state"))
star_query("t4_top_states_by_margin", reports.top_states, with_lines(
    f"""SELECT state, {totals('revenue total_revenue', 'profit total_profit')}, {MARGIN} AS profit_margin FROM lines GROUP BY state
  ORDER BY profit_margin DESC, state LIMIT 10"""))
star_query("t4_top_states_by_profit", lambda s: reports.top_states(s, "total_profit"), with_lines(
    f"""SELECT state, {totals('revenue total_revenue', 'profit total_profit')}, {MARGIN} AS profit_margin FROM lines GROUP BY state
  ORDER BY SUM(profit_c) DESC, state LIMIT 10"""))
star_query("t4_top_customer_values", reports.top_customer_values, with_lines(
    f"""SELECT customer_id, customer_name, {money('revenue')} AS total_revenue, {big(ORDERS)} AS total_orders, {MARGIN} AS profit_margin
  FROM lines GROUP BY customer_id, customer_name ORDER BY SUM(revenue_c) DESC, customer_id LIMIT 50"""))

# --- summaries ---------------------------------------------------------------

star_query("a12_monthly_sales", summaries.monthly_sales, with_lines(
    f"""SELECT year, month, month_name, category_name, {SRP}, {totals('quantity total_quantity')}, {big(ORDERS)} AS total_orders
  FROM lines GROUP BY year, month, month_name, category_name"""))
star_query("a13_customer_summary", summaries.customer_summary, with_lines(
    f"""SELECT customer_key, customer_id, customer_name, segment,
  {totals('sales lifetime_sales', 'revenue lifetime_revenue', 'profit lifetime_profit')}, {big(ORDERS)} AS total_orders,
  MAX(order_date) AS last_order_date FROM lines GROUP BY customer_key, customer_id, customer_name, segment"""))
star_query("a14_product_performance", summaries.product_performance, with_lines(
    f"""SELECT product_key, product_id, product_name, category_name, sub_category, {SRP}, {totals('quantity total_quantity')}
  FROM lines GROUP BY product_key, product_id, product_name, category_name, sub_category"""))

TODAY = dt.date(2001, 7, 10)


def due_partitions(spark, folder):
    """Months to refresh when the ship time stands for the last change of a line."""
    lines = commerce.read(spark, folder, "lineitem").join(
        commerce.read(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    facts = lines.select(commerce.expression("order_date_key"), commerce.expression("order_year"), F.col("l_shipdate").alias("updated_at"))
    return changed_partitions(facts, None, TODAY)


query("sk7_partitions_to_refresh", due_partitions, f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
  CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(MAX(l_shipdate) AS TIMESTAMP) AS last_change
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderdate >= DATE '{TODAY}' - INTERVAL 3 MONTH - INTERVAL 9 DAY AND o_orderdate < DATE '2001-07-01' GROUP BY ALL""")
