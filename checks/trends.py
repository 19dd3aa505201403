"""Windows, ranks, tiles and quantiles."""

from __future__ import annotations

from checks.registry import star_query
from checks.sql_parts import AOV, AVG_DISCOUNT, MARGIN, ORDERS, big, dollars, ratio, totals, with_lines
from pyspark.sql import functions as F

from tillstar.operators import quantiles
from tillstar.plans import trends

DAILY = """daily AS (SELECT order_date AS full_date, SUM(revenue_c) AS rev, SUM(profit_c) AS prof,
  COUNT(DISTINCT order_id) AS orders FROM lines GROUP BY order_date)"""


def mean(frame: str) -> str:
    return ratio(f"(SUM(rev) OVER ({frame}))", f"(COUNT(*) OVER ({frame}) * 100)", 2)


def last(rows: int, order: str) -> str:
    return f"ORDER BY {order} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"


YTD = "SUM(rev) OVER (PARTITION BY year(full_date) ORDER BY full_date ROWS UNBOUNDED PRECEDING)"
star_query("w1_w2_w3_sales_trends_view", trends.sales_trends_view, with_lines(
    f"""SELECT full_date, {dollars('rev')} AS daily_revenue, {dollars('prof')} AS daily_profit, orders AS daily_orders,
  {mean(last(7, 'full_date'))} AS rolling_7day_revenue_avg, {mean(last(30, 'full_date'))} AS rolling_30day_revenue_avg,
  {dollars(YTD)} AS cumulative_ytd_revenue FROM daily""", DAILY))
star_query("w12_monthly_moving_average", trends.monthly_moving_average, with_lines(
    f"""SELECT year, month, month_name, {dollars('rev')} AS total_revenue, {dollars('prof')} AS total_profit,
  {mean(last(3, 'year, month'))} AS revenue_moving_avg FROM months""",
    "months AS (SELECT year, month, month_name, SUM(revenue_c) AS rev, SUM(profit_c) AS prof FROM lines GROUP BY ALL)"))
star_query("w13_profit_waterfall", trends.profit_waterfall, with_lines(
    f"""SELECT sub_category, {dollars('prof')} AS total_profit,
  {dollars('SUM(prof) OVER (ORDER BY sub_category ROWS UNBOUNDED PRECEDING)')} AS cumulative_profit FROM steps""",
    "steps AS (SELECT sub_category, SUM(profit_c) AS prof FROM lines GROUP BY ALL)"))
star_query("w6_top_customers_view", trends.top_customers_view, with_lines(
    f"""SELECT customer_id, customer_name, segment AS market_segment,
  {totals('sales gross_sales', 'revenue total_revenue', 'profit total_profit', 'quantity total_units_purchased')},
  {big(ORDERS)} AS total_orders, {AOV} AS average_order_value, {MARGIN} AS customer_profit_margin,
  CAST(DENSE_RANK() OVER (ORDER BY SUM(revenue_c) DESC) AS BIGINT) AS customer_revenue_rank
  FROM lines GROUP BY customer_id, customer_name, segment"""))
star_query("w7_top_products_view", trends.top_products_view, with_lines(
    f"""SELECT product_id, product_name, category_name, sub_category,
  {totals('sales gross_sales', 'revenue total_revenue', 'profit total_profit', 'quantity total_quantity_sold')},
  {AVG_DISCOUNT} AS average_discount_rate, {MARGIN} AS product_profit_margin,
  CAST(DENSE_RANK() OVER (PARTITION BY category_name ORDER BY SUM(revenue_c) DESC) AS BIGINT) AS category_revenue_rank
  FROM lines GROUP BY product_id, product_name, category_name, sub_category"""))

RFM = """metrics AS (SELECT customer_key, customer_id, customer_name, segment AS market_segment,
  MAX(order_date) AS last_order_date, COUNT(DISTINCT order_id) AS order_frequency, SUM(revenue_c) AS rev
  FROM lines GROUP BY ALL)""", """days AS (SELECT *, CAST((SELECT MAX(last_order_date) FROM metrics) - last_order_date AS INTEGER)
  AS recency_days FROM metrics)""", """scores AS (SELECT *,
  CAST(NTILE(4) OVER (ORDER BY recency_days DESC, customer_key) AS INTEGER) AS r_score,
  CAST(NTILE(4) OVER (ORDER BY order_frequency, customer_key) AS INTEGER) AS f_score,
  CAST(NTILE(4) OVER (ORDER BY rev, customer_key) AS INTEGER) AS m_score FROM days)""", """rfm AS (SELECT *,
  r_score + f_score + m_score AS rfm_total_score, CASE WHEN r_score + f_score + m_score >= 10 THEN 'Champions'
  WHEN r_score + f_score + m_score >= 7 THEN 'Loyal Customers' WHEN r_score + f_score + m_score >= 5
  THEN 'At Risk / Need Attention' ELSE 'Lost / Hibernating' END AS customer_rfm_segment FROM scores)"""
SHOWN = f"""customer_id, customer_name, market_segment, last_order_date, recency_days, order_frequency,
  {dollars('rev')} AS monetary_value, rfm_total_score, customer_rfm_segment"""
star_query("w5_customer_segmentation", trends.customer_segmentation, with_lines(f"SELECT {SHOWN} FROM rfm", *RFM))
star_query("w4_w5_customer_segmentation_view", trends.customer_segmentation_view,
           with_lines(f"SELECT {SHOWN}, r_score, f_score, m_score FROM rfm", *RFM))
star_query("a24_rfm_segment_distribution", trends.segment_distribution, with_lines(
    f"""SELECT customer_rfm_segment, {big('COUNT(*)')} AS total_customers, {dollars('SUM(rev)')} AS total_revenue,
  {ratio('SUM(rfm_total_score)', 'COUNT(*)', 4)} AS average_rfm_score FROM rfm GROUP BY customer_rfm_segment""", *RFM))


def _amounts(star):
    return star.lines("sales", "quantity", "profit").select(
        *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("sales", "quantity", "profit")])


# Positions in cents: quarter p of N values lies at (N - 1) * p, counted from 0.
RANKED = """amounts AS (SELECT 'sales' AS column_name, sales_c AS v FROM lines
  UNION ALL SELECT 'quantity', quantity * 100 FROM lines UNION ALL SELECT 'profit', profit_c FROM lines)""", """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY v) - 1 AS i, COUNT(*) OVER (PARTITION BY column_name) - 1 AS n
  FROM amounts)"""


def quarter(q: int) -> str:
    low = f"MAX(v) FILTER (i = n * {q} // 4)"
    high = f"MAX(v) FILTER (i = (n * {q} + 3) // 4)"
    return f"({low} * (4 - MAX(n) * {q} % 4) + {high} * (MAX(n) * {q} % 4))"


star_query("a18_exact_quantiles", lambda s: quantiles.exact_quantiles(_amounts(s), ("sales", "quantity", "profit"), ("0.25", "0.75")),
           with_lines(f"""SELECT column_name, CAST({quarter(1)} AS DOUBLE) / 400 AS q25, CAST({quarter(3)} AS DOUBLE) / 400 AS q75
  FROM ranked GROUP BY column_name""", *RANKED))
