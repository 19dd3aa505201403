"""Registered queries against their SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SOME = ("a1_revenue_by_month", "a3_top_products_of_category", "a8_kpis", "a21_place_matrix", "w1_w2_w3_sales_trends_view",
        "w5_customer_segmentation", "w7_top_products_view", "m25_retention", "r4_t3_sales_page", "f1_f2_f3_w10_clean",
        "q10_x11_to_x14_transform", "q1_to_q6_validation", "l5_scd2_history", "l7_facts", "f11_region_of_role")


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry_points.queries()) if os.environ.get("TILLSTAR_ALL") else SOME)
def test_same_rows(spark, db, name):
    verdict, _ = compare(spark, db, name, FOLDER)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_sql_has_its_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns[:3] == ["year", "month", "month_name"]


def test_forecast_bounds(spark):
    rows = entry_points.queries()["m26_revenue_forecast"](spark, FOLDER).collect()
    assert len(rows) % 6 == 0 and all(r.lower_bound <= r.forecast <= r.upper_bound for r in rows)


def test_a_period_reaches_the_files_and_chooses_orders_first(spark):
    from tillstar.plans import analytics
    from tillstar.plans.star import SourceStar
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = analytics.monthly_summary(SourceStar(spark, FOLDER), 1997, 3)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    physical = plan[plan.index("== Physical Plan =="):]
    assert "GreaterThanOrEqual(o_orderdate,1997-03-01" in physical and "LessThan(o_orderdate,1997-04-01" in physical
    # the lines meet the chosen orders below their first aggregation
    assert physical.index("LeftSemi") > physical.index("HashAggregate")


def test_totals_filter_by_key_and_measure(spark):
    from pyspark.sql import functions as F

    from tillstar.plans.star import SourceStar
    rows = SourceStar(spark, FOLDER).totals(("product_key",), ("profit",), where=(F.col("product_key") < 10) & (F.col("profit") < 0)).collect()
    assert rows and all(r.product_key < 10 and r.profit < 0 for r in rows)
