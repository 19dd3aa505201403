"""Aggregations, top-k and joins over the star."""

from __future__ import annotations

import datetime as dt

from checks.registry import star_query
from checks.sql_parts import AOV, AVG_DISCOUNT, MARGIN, ORDERS, SRP, big, dollars, ratio, totals, with_lines
from tillstar.plans import analytics

YEAR, MONTH = 1997, 3
CATEGORY, REGION = "ECONOMY", "ASIA"
START, END = dt.date(1996, 7, 1), dt.date(1998, 2, 15)
SRPQ = SRP + ", " + totals("quantity total_quantity")


def revenue_by_month(where: str = "") -> str:
    return with_lines(f"""SELECT year, month, month_name, {SRPQ}, {big(ORDERS)} AS total_orders,
  {AOV} AS average_order_value, {MARGIN} AS profit_margin FROM lines {where} GROUP BY year, month, month_name""")


star_query("a1_revenue_by_month", analytics.revenue_by_month, revenue_by_month())
star_query("a1_revenue_by_month_of_year", lambda s: analytics.revenue_by_month(s, YEAR), revenue_by_month(f"WHERE year = {YEAR}"))
star_query("a1_monthly_revenue_view", analytics.monthly_revenue_view, with_lines(
    f"""SELECT year, month, month_name, {totals('sales gross_sales', 'revenue net_revenue', 'profit total_profit', 'quantity total_units_sold')},
  {big(ORDERS)} AS total_orders, {AOV} AS average_order_value, {MARGIN} AS net_profit_margin
  FROM lines GROUP BY year, month, month_name"""))
star_query("a2_top_customers", analytics.top_customers, with_lines(
    f"""SELECT customer_id, customer_name, segment, {SRP}, {big(ORDERS)} AS total_orders, {MARGIN} AS profit_margin
  FROM lines GROUP BY customer_id, customer_name, segment ORDER BY SUM(revenue_c) DESC, customer_id LIMIT 10"""))


def top_products(limit: int, where: str = "") -> str:
    return with_lines(f"""SELECT product_id, product_name, category_name, sub_category, {SRPQ}, {AVG_DISCOUNT} AS average_discount
  FROM lines {where} GROUP BY product_id, product_name, category_name, sub_category
  ORDER BY SUM(revenue_c) DESC, product_id LIMIT {limit}""")


star_query("a3_top_products", analytics.top_products, top_products(10))
star_query("a3_top_products_of_category", lambda s: analytics.top_products(s, 5, CATEGORY),
           top_products(5, f"WHERE category_name = '{CATEGORY}'"))
star_query("a4_regional_performance", analytics.regional_performance, with_lines(
    f"""SELECT region, country, state, {SRP}, {big(ORDERS)} AS total_orders, {MARGIN} AS profit_margin
  FROM lines GROUP BY region, country, state"""))
star_query("a4_regional_performance_view", analytics.regional_performance_view, with_lines(
    f"""SELECT region, country, state, city, {totals('sales gross_sales', 'revenue total_revenue', 'profit total_profit', 'quantity total_units_sold')},
  {big(ORDERS)} AS total_orders, {MARGIN} AS regional_profit_margin FROM lines GROUP BY region, country, state, city"""))

for grain, keys in {"daily": "order_date", "weekly": "year, week_of_year", "quarterly": "year, quarter",
                    "monthly": "year, month, month_name"}.items():
    shown = keys.replace("order_date", "order_date AS full_date")
    star_query(f"a5_sales_trends_{grain}", lambda s, g=grain: analytics.sales_trends(s, g), with_lines(
        f"SELECT {shown}, {SRP}, {big(ORDERS)} AS total_orders FROM lines GROUP BY {keys}"))

for by, keys in {"product": "product_id, product_name, category_name, sub_category", "region": "region, state, city",
                 "customer": "customer_id, customer_name, segment", "category": "category_name, ship_mode"}.items():
    star_query(f"a6_profitability_by_{by}", lambda s, b=by: analytics.profitability_analysis(s, b), with_lines(
        f"SELECT {keys}, {SRP}, {MARGIN} AS profit_margin FROM lines GROUP BY {keys}"))

star_query("a7_profitability_view", analytics.profitability_view, with_lines(
    f"""SELECT category_name, sub_category, product_id, product_name,
  {totals('sales gross_sales', 'revenue total_revenue', 'profit total_profit', 'quantity total_units_sold')},
  {MARGIN} AS profit_margin, {dollars('SUM(sales_c - revenue_c)')} AS total_discounts_granted,
  {AVG_DISCOUNT} AS average_discount_rate
  FROM lines GROUP BY product_id, product_name, category_name, sub_category"""))
star_query("a8_kpis", analytics.get_kpis, with_lines(
    f"""SELECT {totals('sales gross_sales', 'revenue net_revenue', 'profit total_profit', 'quantity total_quantity')},
  {big(ORDERS)} AS total_orders, {big('COUNT(DISTINCT customer_key)')} AS total_customers,
  {AOV} AS average_order_value, {MARGIN} AS net_profit_margin FROM lines"""))
star_query("a9_discount_impact", analytics.discount_impact, with_lines(
    f"""SELECT {dollars('discount_c')} AS discount_rate, {big('COUNT(*)')} AS transaction_count, {SRP}, {MARGIN} AS profit_margin,
  {big('SUM(quantity)')} AS total_units_sold FROM lines GROUP BY discount_c"""))


def sales_summary(where: str = "") -> str:
    return with_lines(f"""SELECT {dollars('COALESCE(SUM(revenue_c), 0)')} AS total_revenue,
  {dollars('COALESCE(SUM(profit_c), 0)')} AS total_profit, {big(ORDERS)} AS total_orders,
  {big('COUNT(DISTINCT customer_key)')} AS total_customers, {big('COALESCE(SUM(quantity), 0)')} AS total_units_sold,
  {AOV} AS avg_order_value, {MARGIN} AS profit_margin FROM lines {where}""")


star_query("a10_sales_summary", analytics.sales_summary, sales_summary())
star_query("a10_sales_summary_of_period_and_region", lambda s: analytics.sales_summary(s, START, END, REGION), sales_summary(
    f"WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}' AND region = '{REGION}'"))
star_query("a11_monthly_summary", lambda s: analytics.monthly_summary(s, YEAR, MONTH), with_lines(
    f"""SELECT metric_name, metric_value FROM (
    SELECT {dollars('SUM(revenue_c)')} AS r, {dollars('SUM(profit_c)')} AS p, CAST({ORDERS} AS DOUBLE) AS o, {AOV} AS v
    FROM lines WHERE year = {YEAR} AND month = {MONTH}) AS totals,
  LATERAL (VALUES ('Monthly Revenue', r), ('Monthly Profit', p), ('Monthly Orders', o), ('Average Order Value', v)) AS t(metric_name, metric_value)"""))
star_query("w8_monthly_growth", analytics.monthly_growth, with_lines(
    f"""SELECT year, month, month_name, {dollars('rev')} AS monthly_revenue, {dollars('prior')} AS prior_month_revenue,
  {ratio('(rev - prior) * 100', 'prior', 2)} AS mom_growth_pct
  FROM (SELECT *, lag(rev) OVER (ORDER BY year, month) AS prior FROM months) AS g""",
    "months AS (SELECT year, month, month_name, SUM(revenue_c) AS rev FROM lines GROUP BY ALL)"))
star_query("f9_loss_makers", analytics.loss_makers, with_lines(
    f"""SELECT product_key, {dollars('SUM(profit_c)')} AS total_loss, {big('COUNT(*)')} AS losing_lines
  FROM lines WHERE profit_c < 0 GROUP BY product_key"""))
