import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import ROWS, changed, write_csv
from tillstar.operators import clean, dimensions, facts, features, quality, scd2
from tillstar.plans import analytics, measures, reads
from tillstar.plans.load import load_all, run, run_daily
from tillstar.plans.star import WarehouseStar, join_date, secured
from tillstar.plans.summaries import refresh_summaries
from tillstar.schemas import RAW, TABLES
from tillstar.schemas import FACTS
from tillstar.sources.store import Store, changed_partitions, overwrite_partitions, table_counts


def silver(spark, rows=ROWS):
    return features.transform(clean.clean(spark.createDataFrame(rows, RAW)))


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "warehouse"))
    made.create_tables()
    return made


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("loaded")))
    made.create_tables()
    counts = load_all(made, silver(spark))
    return made, counts


def test_first_load(loaded):
    store, counts = loaded
    assert counts == {"dim_date": 365, "dim_category": 3, "dim_region": 2, "dim_customer": 2, "dim_product": 3, FACTS: 3, "rejected": 0}
    tables = store.tables()
    assert {r.category_name for r in tables["dim_category"].collect()} == {"Technology", "Furniture", "Office Supplies"}
    assert {r.city for r in tables["dim_region"].collect()} == {"Los Angeles", "New York City"}
    first = WarehouseStar(tables).lines("order_id", "customer_id", "product_id", "sales").filter("product_id = 'PH-1'").first()
    assert (first.customer_id, first.sales) == ("NL-204", Decimal("250.00"))
    assert tables[FACTS].select("sales_key").distinct().count() == 3


def test_second_load_adds_only_facts_unless_idempotent(spark, store):
    batch = silver(spark)
    load_all(store, batch)
    again = load_all(store, batch, idempotent=True)
    assert all(n == 0 for n in again.values())
    plain = load_all(store, batch)
    assert plain[FACTS] == 3 and sum(plain.values()) == 3
    assert store.read(FACTS).count() == 6
    assert store.read(FACTS).select("sales_key").distinct().count() == 6


def test_scd2_two_batches(spark, store):
    def batch(segment, day):
        return spark.createDataFrame([("ZK-1", "Zoe Kern", segment, day)],
                                     "`Customer ID` string, `Customer Name` string, Segment string, `Order Date` date")

    one, new = scd2.apply_customers(store.read("dim_customer"), batch("Consumer", dt.date(2022, 1, 1)))
    assert new.count() == 1
    one = store.replace("dim_customer", one)
    same, none = scd2.apply_customers(one, batch("Consumer", dt.date(2022, 3, 1)))
    assert none.count() == 0 and same.count() == 1
    two, new = scd2.apply_customers(one, batch("Corporate", dt.date(2022, 6, 15)))
    rows = {r.is_current: r for r in two.collect()}
    assert new.count() == 1 and len(rows) == 2
    assert (rows[False].segment, rows[False].expiry_date) == ("Consumer", dt.date(2022, 6, 14))
    assert (rows[True].segment, rows[True].effective_date, rows[True].expiry_date) == ("Corporate", dt.date(2022, 6, 15), None)
    late, _ = scd2.apply_customers(one, batch("Corporate", dt.date(2021, 1, 1)))
    assert quality.inverted_versions(late).first().affected_rows == 1
    assert quality.inverted_versions(two).first().affected_rows == 0


def test_scd2_history_and_as_of(spark):
    day = lambda m: dt.date(2022, m, 1)
    changes = spark.createDataFrame(
        [("c", "N", "A", day(1), "1"), ("c", "N", "A", day(2), "2"), ("c", "N", None, day(3), "3"), ("c", "N", "B", day(3), "4"),
         ("c", "N", None, day(5), "5"), ("d", "M", "A", day(1), "6")],
        "customer_id string, customer_name string, segment string, order_date date, row_id string")
    out = scd2.scd2_history(changes, "customer_id", ("customer_name", "segment"), "order_date", scd2.latest_first(changes)[1:])
    got = [(r.segment, r.effective_date, r.expiry_date, r.is_current) for r in out.filter("customer_id = 'c'").orderBy("effective_date").collect()]
    assert got == [("A", day(1), dt.date(2022, 2, 28), False), ("B", day(3), dt.date(2022, 4, 30), False), (None, day(5), None, True)]
    assert out.filter("is_current").count() == 2


def test_rejects_and_fallback(spark, loaded):
    tables = loaded[0].tables()
    rows = [changed(ROWS[0], Row_ID="11", Order_ID="N1", Postal_Code="99999"), changed(ROWS[0], Row_ID="12", Order_ID="N2", City="Paris"),
            changed(ROWS[0], Row_ID="13", Order_ID="N3", Customer_ID="who"), changed(ROWS[0], Row_ID="14", Order_ID="N4", Product_ID="what"),
            changed(ROWS[0], Row_ID="15", Order_ID="N5", Category="Garden"), changed(ROWS[0], Row_ID="16", Order_ID="N6", Ship_Date="2030-01-01"),
            changed(ROWS[0], Row_ID="17", Order_ID="N7", Order_Date="2001-01-01")]
    resolved = facts.resolve_keys(silver(spark, rows), tables)
    reasons = {r["Order ID"]: r.reject_reason for r in resolved.collect()}
    assert reasons == {"N1": None, "N2": "region", "N3": "customer", "N4": "product", "N5": "category", "N6": "ship date", "N7": "order date"}
    assert facts.fact_rows(resolved).count() + facts.rejected_lines(resolved).count() == len(rows)
    checks = quality.referential_integrity(silver(spark, rows), tables["dim_customer"], tables["dim_product"], tables["dim_region"])
    assert [r.affected_rows for r in checks.orderBy("rule_name").collect()] == [1, 1, 1]
    with pytest.raises(ValueError):
        facts.resolve_keys(silver(spark), tables, "sometimes")


def lost_lines():
    return [ROWS[1], changed(ROWS[0], Row_ID="12", Order_ID="N2", City="Paris"), changed(ROWS[0], Row_ID="13", Order_ID="N3", Customer_ID="who"),
            changed(ROWS[0], Row_ID="14", Order_ID="N4", Product_ID="what"), changed(ROWS[0], Row_ID="15", Order_ID="N5", Category="Garden"),
            changed(ROWS[0], Row_ID="16", Order_ID="N6", Ship_Date="2030-01-01"), changed(ROWS[2], Row_ID="17", Order_ID="N7")]


@pytest.mark.parametrize("resolve", ["current", "as_of"])
def test_thin_lines_give_the_same_facts_and_rejects(spark, loaded, resolve):
    tables = loaded[0].tables()
    # two lines more whose product and customer are missing altogether
    nulls = silver(spark, ROWS[:1]).withColumns({"Order ID": F.lit("N8"), "Product ID": F.lit(None).cast("string")}).unionByName(
        silver(spark, ROWS[:1]).withColumns({"Order ID": F.lit("N9"), "Customer ID": F.lit(None).cast("string")}))
    batch = silver(spark, lost_lines()).unionByName(nulls)
    whole, thin = (facts.kept_of(facts.resolve_keys(batch, tables, resolve, thin=t)) for t in (False, True))
    shown = [c for c in whole.columns if c not in ("created_at", "updated_at")]
    assert sorted(map(repr, whole.select(shown).collect())) == sorted(map(repr, thin.select(shown).collect()))
    assert whole.where("reject_reason IS NOT NULL").count() == 7
    lines = facts.resolve_keys(batch, tables, resolve, thin=True).collect()
    assert {r["Order ID"] for r in lines if r["Row ID"] is None} == {r["Order ID"] for r in lines if r.reject_reason is None}


def test_facts_are_compared_only_where_some_are_loaded(spark, store, monkeypatch):
    asked = []
    compare = facts.without_loaded
    monkeypatch.setattr(facts, "without_loaded", lambda rows, known: asked.append(1) or compare(rows, known))
    assert load_all(store, silver(spark), idempotent=True)[FACTS] == 3 and not asked
    assert load_all(store, silver(spark), idempotent=True)[FACTS] == 0 and asked
    later = changed(ROWS[0], Row_ID="21", Order_ID="N1", Order_Date="2023-02-01", Ship_Date="2023-02-03")
    assert load_all(store, silver(spark, [later]), idempotent=True)[FACTS] == 1 and len(asked) == 1


def test_as_of_resolution(spark, loaded):
    tables = dict(loaded[0].tables())
    tables["dim_customer"] = spark.createDataFrame(
        [(1, "NL-204", dt.date(2022, 1, 1), dt.date(2022, 5, 9), False), (2, "NL-204", dt.date(2022, 5, 10), None, True)],
        "customer_key bigint, customer_id string, effective_date date, expiry_date date, is_current boolean")
    rows = [ROWS[0], changed(ROWS[1], Order_Date="2022-03-01", Order_ID="OLD")]
    out = {r["Order ID"]: r.customer_key for r in facts.resolve_keys(silver(spark, rows), tables, "as_of").collect()}
    assert out == {"ORD-77-1": 2, "OLD": 1}


def fact_scan(df):
    """The part of the formatted plan that describes the scan of the facts."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return next(part for part in text.split("\n\n") if "Scan parquet" in part and "order_date_key" in part)


def test_year_filter_prunes_partitions(loaded):
    star = WarehouseStar(loaded[0].tables())
    scan = fact_scan(analytics.revenue_by_month(star, 2022))
    assert "PartitionFilters" in scan and "2022" in scan
    scan = fact_scan(reads.sales_lines(star, dt.date(2022, 1, 1), dt.date(2022, 2, 1)))
    assert "PartitionFilters" in scan and "(order_year" in scan and "GreaterThanOrEqual(order_date_key,20220101)" in scan


def test_queries_over_stored_star(loaded):
    star = WarehouseStar(loaded[0].tables())
    kpi = analytics.get_kpis(star).first()
    assert (kpi.net_revenue, kpi.total_orders, kpi.total_customers) == (Decimal("373.50"), 2, 2)
    assert analytics.get_kpis(star).first().average_order_value == Decimal("186.75")
    assert analytics.revenue_by_month(star).count() == 2
    assert analytics.top_customers(star, 1).first().customer_id == "NL-204"
    board = reads.dashboard(star)
    assert {r.category: r.sales for r in board["sales_by_category"].collect()}["Furniture"] == Decimal("108.00")
    assert {r.region: r.sales for r in board["sales_by_region"].collect()} == {"West": Decimal("358.00"), "East": Decimal("15.50")}
    assert reads.customer(star, "nobody").isEmpty()
    assert reads.customer(star, "IM-311").first().customer_name == "Ivo Marek"
    assert reads.product(star, "CH-2").first().category_name == "Furniture"
    assert analytics.regional_performance(secured(star, "West Manager")).count() == 1
    with pytest.raises(PermissionError):
        secured(star, "Nobody")
    shipping = measures.measure_table(star, (), ("average_shipping_days", "orders")).first()
    assert shipping.average_shipping_days == pytest.approx(11 / 3) and shipping.orders == 2


def test_empty_star_gives_zeros(spark, tmp_path):
    made = Store(spark, str(tmp_path / "empty"))
    kpi = analytics.get_kpis(WarehouseStar(made.tables())).first()
    assert all(v == 0 for v in kpi)
    totals = analytics.sales_summary(WarehouseStar(made.tables())).first()
    assert (totals.total_revenue, totals.total_orders, totals.avg_order_value) == (0, 0, None)


def test_pages(spark):
    df = spark.range(45).withColumnRenamed("id", "k")
    assert [r.k for r in reads.page(df, [F.desc("k")], 3, 20).collect()] == [4, 3, 2, 1, 0]
    assert [r.k for r in reads.page_after(df, "k", 2, 20).collect()] == [1, 0]
    assert reads.page_info(df, 1, 20).first().total_pages == 3
    assert (reads.page_count(0, 20), reads.page_count(41, 20)) == (0, 3)
    for number, size in ((0, 20), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            reads.page(df, [F.col("k")], number, size)
    with pytest.raises(ValueError):
        analytics.in_period(dt.date(2022, 2, 1), dt.date(2022, 1, 1))


def test_summaries_are_versioned(loaded):
    store, _ = loaded
    star = WarehouseStar(store.tables())
    refresh_summaries(store, star, ["mv_customer_summary"])
    refresh_summaries(store, star)
    assert store.versions("mv_customer_summary") == [1, 2]
    assert store.spark.table("mv_monthly_sales").count() == 3
    assert {r.last_order_date for r in store.read("mv_customer_summary").collect()} == {dt.date(2022, 5, 10), dt.date(2022, 6, 15)}


def test_store_health_and_drop(loaded, spark, tmp_path):
    rows = {r.table_name: r for r in loaded[0].health().collect()}
    assert rows[FACTS].row_count == 3 and rows[FACTS].size_bytes > 0
    made = Store(spark, str(tmp_path / "w"))
    assert {r.row_count for r in made.health().collect()} == {-1}
    made.create_tables()
    assert {r.row_count for r in table_counts(made.tables()).collect()} == {0}
    made.register_views(("dim_date",))
    assert spark.table("dim_date").count() == 0
    made.drop_tables()
    assert not any(made.exists(t) for t in TABLES)


def test_partition_refresh(spark, tmp_path):
    ts = lambda d: dt.datetime(2024, 6, d)
    facts_df = spark.createDataFrame(
        [(20240615, 2024, ts(1)), (20240510, 2024, ts(2)), (20240411, 2024, ts(3)), (20240301, 2024, ts(4)), (20240320, 2024, ts(5))],
        "order_date_key int, order_year int, updated_at timestamp")
    due = changed_partitions(facts_df, None, dt.date(2024, 6, 20))
    assert {(r.order_month, r.last_change) for r in due.collect()} == {(5, ts(2)), (4, ts(3)), (3, ts(5))}
    seen = due.filter("order_month <> 5").unionByName(due.filter("order_month = 5").withColumn("last_change", F.lit(ts(1))))
    assert [r.order_month for r in changed_partitions(facts_df, seen, dt.date(2024, 6, 20)).collect()] == [5]
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    overwrite_partitions(df, path, ("p",))
    overwrite_partitions(spark.createDataFrame([(2, "c")], "p int, v string"), path, ("p",))
    assert {(r.p, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2021, 3, 1), dt.date(2024, 2, 1))], "a date, b date")
    days = dimensions.calendar(df, "a", "b")
    assert days.count() == 1461 and days.columns == [f.name for f in TABLES["dim_date"].fields]
    leap = days.filter("date_key = 20240229").first()
    assert (leap.day_of_year, leap.week_of_year, leap.fiscal_quarter, leap.fiscal_year, leap.is_weekend) == (60, 9, 4, 2023, False)
    assert dimensions.calendar(spark.createDataFrame([], "a date, b date"), "a", "b").count() == 0


def test_whole_run(spark, csv_file, tmp_path):
    result = run_daily(spark, csv_file, str(tmp_path / "work"), staging=True, name="first")
    assert (result.status, result.exit_code, result.errors) == ("SUCCESS", 0, [])
    assert (result.rows_extracted, result.rows_cleaned, result.rows_transformed, result.rows_loaded) == (3, 3, 3, 3)
    assert (result.raw_quality_score, result.transformed_quality_score) == (100.0, 100.0)
    assert set(result.stage_seconds) == {"extract", "raw_validation", "clean", "transform", "transformed_validation", "load"}
    assert result.as_row(spark).first().rows_loaded == 3
    made = Store(spark, str(tmp_path / "work" / "warehouse"))
    assert made.read("mv_product_performance").count() == 3
    assert made.read("stg_raw_sales").where("row_id = '1'").first().sales == "250.00"
    assert made.read("stg_clean_sales").where("row_id = '1'").first().revenue == Decimal("250.00")
    assert run(spark, csv_file, str(tmp_path / "work"), name="first").rows_loaded == 0
    reports = spark.read.json(str(tmp_path / "work" / "reports" / "*"))
    assert {r.stage for r in reports.select("stage").collect()} == {"raw", "transformed", "post_load"}


def test_run_modes_and_failures(spark, csv_file, tmp_path):
    checked = run(spark, csv_file, str(tmp_path / "a"), mode="validate")
    assert (checked.status, checked.rows_extracted, checked.rows_cleaned) == ("SUCCESS", 3, 0)
    dry = run(spark, csv_file, str(tmp_path / "b"), mode="dry-run")
    assert (dry.rows_transformed, dry.rows_loaded) == (3, 0)
    failed = run(spark, str(tmp_path / "none.csv"), str(tmp_path / "c"))
    assert (failed.status, failed.exit_code) == ("FAILED", 1)
    empty = run(spark, write_csv(tmp_path / "empty.csv", []), str(tmp_path / "d"))
    assert empty.status == "FAILED" and "no order lines" in empty.errors[0]
    bad = write_csv(tmp_path / "bad.csv", [*ROWS, changed(ROWS[0], Row_ID="4", Order_ID="B", Ship_Date="2020-01-01")])
    flagged = run(spark, bad, str(tmp_path / "e"))
    assert (flagged.status, flagged.exit_code, flagged.rows_loaded, flagged.rows_rejected) == ("QUALITY_FAILURE", 2, 3, 1)
    stopped = run(spark, bad, str(tmp_path / "f"), on_critical="stop")
    assert (stopped.status, stopped.rows_cleaned) == ("QUALITY_FAILURE", 0)


def test_join_date_keeps_every_fact(loaded):
    tables = loaded[0].tables()
    assert join_date(tables[FACTS], tables["dim_date"]).count() == 3


def test_ids_of_any_length(spark):
    from tillstar.operators.dedup import first_per_key, row_order
    ids = ["10000000000000000000", "9000000000000000000", "0000000000000000000000012", "7", "x1", "12345678901234567890123456"]
    df = spark.createDataFrame([(i, k) for i in ids for k in ("all", i)], "`Row ID` string, k string")
    order = row_order(df)
    assert [r["Row ID"] for r in df.where("k = 'all'").orderBy(*[c.asc_nulls_last() for c, _ in order]).collect()] == [
        "7", "0000000000000000000000012", "9000000000000000000", "10000000000000000000", "12345678901234567890123456", "x1"]
    assert first_per_key(df.where("k = 'all' and `Row ID` like '%0000000000'"), ("k",), order).first()["Row ID"] == "9000000000000000000"


def test_a_run_leaves_no_scratch(spark, csv_file, tmp_path):
    from pathlib import Path

    from tillstar.session import scratch_root
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    assert run(spark, csv_file, str(tmp_path / "work")).rows_loaded == 3
    assert run(spark, str(tmp_path / "nothing.csv"), str(tmp_path / "work")).status == "FAILED"
    assert set(root.iterdir()) == before
