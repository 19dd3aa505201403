"""SQL fragments shared by the oracle queries. Amounts are whole cents here, so
that every sum and rounding is integer arithmetic."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT *,
    (sales_c * (100 - discount_c) + 50) // 100 AS revenue_c,
    CASE WHEN profit_raw < 0 THEN -((-profit_raw + 50) // 100) ELSE (profit_raw + 50) // 100 END AS profit_c
  FROM (
    SELECT *, sales_c * (100 - discount_c) - 95 * quantity * retail_c AS profit_raw FROM (
      SELECT
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS line_id,
        l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS order_id,
        CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
        CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key,
        CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter, monthname(o_orderdate) AS month_name,
        CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
        o_orderpriority AS ship_mode,
        o_custkey AS customer_key, CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
        c_mktsegment AS segment, n_name AS country, r_name AS region,
        n_name || '_S' || CAST(o_custkey % 3 AS VARCHAR) AS state,
        n_name || '_C' || CAST(o_custkey % 9 AS VARCHAR) AS city,
        lpad(CAST(c_nationkey * 100 + o_custkey % 9 AS VARCHAR), 5, '0') AS postal_code,
        l_partkey AS product_key, CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name,
        p_type AS category_name, p_brand AS sub_category,
        CAST(l_quantity AS INTEGER) AS quantity,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS sales_c,
        CAST(round(l_discount * 100) AS BIGINT) AS discount_c,
        CAST(round(p_retailprice * 100) AS BIGINT) AS retail_c
      FROM lineitem
      JOIN orders ON o_orderkey = l_orderkey
      JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey
      JOIN part ON p_partkey = l_partkey
    ) AS joined_lines
  ) AS costed_lines
)"""


def with_lines(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LINES.strip(), *ctes]) + "\n" + body


def ratio(num: str, den: str, digits: int) -> str:
    """Quotient of two integers rounded half away from zero, NULL on zero."""
    scale = 10 ** digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    whole = f"((2 * {scale} * abs({n}) + abs({d})) // (2 * abs({d})))"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({sign} * {whole} AS DOUBLE) / {scale} END)"


def dollars(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def big(count: str) -> str:
    return f"CAST({count} AS BIGINT)"


def totals(*pairs: str) -> str:
    """``totals('sales total_sales', ...)``: sums of cents in currency units."""
    out = []
    for pair in pairs:
        measure, name = pair.split()
        out.append(f"{big('SUM(quantity)')} AS {name}" if measure == "quantity"
                   else f"{dollars(f'SUM({measure}_c)')} AS {name}")
    return ", ".join(out)


ORDERS = "COUNT(DISTINCT order_id)"
MARGIN = ratio("SUM(profit_c)", "SUM(revenue_c)", 4)
AOV = ratio("SUM(revenue_c)", f"({ORDERS} * 100)", 2)
AVG_DISCOUNT = ratio("SUM(discount_c)", "(COUNT(*) * 100)", 4)
SRP = totals("sales total_sales", "revenue total_revenue", "profit total_profit")
