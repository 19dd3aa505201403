import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import ROWS, changed
from tests.test_load import fact_scan
from tillstar.operators import clean, facts, features, scd2
from tillstar.plans import load as loading
from tillstar.plans import analytics, summaries
from tillstar.plans.load import load_all
from tillstar.plans.star import WarehouseStar
from tillstar.schemas import CUSTOMER_HISTORY, FACTS, RAW, REJECTS, STAGING_CLEAN, STAGING_RAW, TABLES
from tillstar.sources.store import Conflict, Store, table_counts

LATER = [changed(ROWS[0], Row_ID="21", Order_ID="L1", Order_Date="2023-02-01", Ship_Date="2023-02-03", Customer_ID="NEW-1", Customer_Name="Una New", City="Reno"),
         changed(ROWS[1], Row_ID="22", Order_ID="L2", Order_Date="2023-03-01", Ship_Date="2023-03-03", Product_ID="CH-9", Product_Name="Stool")]


def silver(spark, rows=ROWS):
    from tillstar.schemas import RAW
    return features.transform(clean.clean(spark.createDataFrame(rows, RAW)))


def state(store):
    return {r.table_name: r.row_count for r in table_counts(store.tables()).collect()}


def test_a_killed_load_shows_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark), name="day", number=1)
    before, number = state(store), store.commit().number

    def killed(*args, **options):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(loading, "load_facts", killed)
        with pytest.raises(RuntimeError, match="killed"):
            load_all(store, silver(spark, LATER), name="day", number=2)
    assert state(store) == before and store.commit().number == number
    left = store.remove_unnamed()
    assert any(p.startswith("dim_product/") for p in left) and state(store) == before
    assert load_all(store, silver(spark, LATER), name="day", number=2)[FACTS] == 2
    assert state(store)[FACTS] == 5
    with monkeypatch.context() as patch:  # a repeated load neither reads nor writes
        for name in ("read", "write", "read_buckets"):
            patch.setattr(loading.Load, name, killed)
        for number in (1, 2):
            assert not any(load_all(store, silver(spark, LATER), name="day", number=number).values())
    parts = {(r.load, r.rows, r.first_year, r.last_year) for r in store.parts().where("table_name = 'fact_sales'").collect()}
    assert parts == {("day", 3, 2022, 2022), ("day", 2, 2023, 2023)}


def test_only_the_years_of_the_batch_are_read(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark))
    load_all(store, silver(spark, LATER))
    load = store.load()
    scan = fact_scan(load.read(FACTS, [2023]).select("order_id", "order_date_key", "order_year"))
    assert "(order_year" in scan and "2023" in scan
    assert {f.split("/order_year=")[1][:4] for f in load.read(FACTS, [2023]).inputFiles()} == {"2023"}
    assert len(load.store.frame(FACTS, load.parts(FACTS)).inputFiles()) > len(load.read(FACTS, [2023]).inputFiles())
    assert load_all(store, silver(spark, LATER), idempotent=True)[FACTS] == 0
    keys = [r.sales_key for r in store.read(FACTS).select("sales_key").collect()]
    assert len(set(keys)) == 5 and max(keys) == store.load().largest(FACTS)


def test_the_slower_of_two_loads_begins_again(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    one, two = store.load("one"), store.load("two")
    day = spark.createDataFrame([(20240101,)], "date_key int").selectExpr(*[
        f"CAST({'date_key' if f.name == 'date_key' else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in TABLES["dim_date"].fields])
    one.append("dim_date", day)
    two.append("dim_date", day)
    one.commit()
    with pytest.raises(Conflict):
        two.commit()
    assert store.read("dim_date").count() == 1 and not store.load("two").repeated and store.load("one").repeated


def test_rejects_are_kept(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark))
    load = store.load("facts only")
    rows = [changed(ROWS[0], Row_ID="13", Order_ID="N3", Customer_ID="who"), changed(ROWS[0], Row_ID="14", Order_ID="N4", Product_ID="what")]
    assert loading.load_facts(load, silver(spark, rows)) == (0, 2)
    load.commit()
    assert {(r.load, r.row_id, r.reject_reason, r.customer_id, r.sales) for r in store.read(REJECTS).collect()} == {
        ("facts only", "13", "customer", "who", 250), ("facts only", "14", "product", "NL-204", 250)}


ATTRIBUTES = ("customer_name", "segment")


def shuffled_batches(seed, customers, days):
    draw = random.Random(seed)
    rows = [(f"c{draw.randrange(customers)}", "N", draw.choice(["A", "B", None]), dt.date(2022, 1, 1) + dt.timedelta(draw.randrange(days)), str(k)) for k in range(300)]
    draw.shuffle(rows)
    return rows, [rows[:120], rows[120:130], rows[130:250], rows[250:]]


@pytest.mark.parametrize("seed, customers, days", [(1, 12, 40), (2, 2, 400)])
def test_batches_in_any_order_give_the_whole_history(spark, seed, customers, days):
    kinds = "customer_id string, customer_name string, segment string, order_date date, row_id string"
    rows, batches = shuffled_batches(seed, customers, days)
    whole = spark.createDataFrame(rows, kinds)
    want = scd2.scd2_history(whole, "customer_id", ATTRIBUTES, "order_date", scd2.latest_first(whole)[1:])
    now, numbers, added = spark.createDataFrame([], CUSTOMER_HISTORY), {}, 0
    for batch in batches:
        now, n = scd2.splice(now, spark.createDataFrame(batch, kinds), "customer_id", ATTRIBUTES, "order_date", "row_id", "customer_key", max(numbers.values(), default=0))
        got = now.collect()
        added += n
        fresh = {(r.customer_id, d.day): r.customer_key for r in got for d in r.seen}
        # whoever referred to a version finds it again, with the day it began on
        assert all(fresh[r] == k for r, k in numbers.items())
        numbers = {(r.customer_id, r.effective_date): r.customer_key for r in got}
        assert len(set(numbers.values())) == len(got)
        now = spark.createDataFrame(got, CUSTOMER_HISTORY)
    assert added == len(got)
    columns = ("customer_id", "customer_name", "segment", "effective_date", "expiry_date", "is_current")
    merged = lambda df: sorted([tuple(r) for r in df.select(*columns).collect()], key=str)
    assert all(r.expiry_date is None or r.expiry_date >= r.effective_date for r in got)
    # A correction of a day may leave two stored versions with equal attributes, which stay two.
    assert merged(scd2.collapsed(now, "customer_id", ATTRIBUTES)) == merged(want)


def test_a_late_change_touches_its_bucket_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    kinds = "`Customer ID` string, `Customer Name` string, Segment string, `Order Date` date, `Row ID` string"
    rows = [(f"c{k}", "N", "A", dt.date(2022, 5, 1), str(k)) for k in range(60)]

    def put(batch):
        load = store.load()
        n = loading.load_customers(load, spark.createDataFrame(batch, kinds))
        load.commit()
        return n, {r.bucket: (r.path, r.rows) for r in store.parts().where("table_name = 'dim_customer'").collect()}

    assert put(rows)[0] == 60
    _, first = put([])
    n, now = put([("c7", "N", "B", dt.date(2022, 3, 1), "99")])
    assert n == 1 and len([b for b in now if now[b] != first[b]]) == 1 and sum(r for _, r in now.values()) == 61
    versions = sorted((r.effective_date, r.expiry_date, r.segment, r.is_current) for r in store.read("dim_customer").where("customer_id = 'c7'").collect())
    assert versions == [(dt.date(2022, 3, 1), dt.date(2022, 4, 30), "B", False), (dt.date(2022, 5, 1), None, "A", True)]
    assert len(store.remove_unnamed()) > 0 and store.read("dim_customer").count() == 61


def test_as_of_of_a_hot_customer_makes_no_product(spark):
    day = dt.date(2015, 1, 1)
    versions = [(k, "hot", day + dt.timedelta(2 * k), day + dt.timedelta(2 * k + 1) if k % 5 else day + dt.timedelta(2 * k), k == 999) for k in range(1000)]
    versions += [(5000, "cold", day, None, True), (5001, None, day, None, True)]
    known = spark.createDataFrame(versions, "customer_key long, customer_id string, effective_date date, expiry_date date, is_current boolean")
    lines = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "cold").when(F.col("id") % 6 == 2, "none").alias("Customer ID"),
        F.date_add(F.lit(day), (F.col("id") % 2100).cast("int") - 50).alias("Order Date"))
    got = facts._customer_lookup(lines, known, "as_of")
    assert got.count() == 20_000
    best = {}
    for k, c, a, b, _ in versions:
        for n in range(((b or dt.date(2022, 1, 1)) - a).days + 1):
            best[c, a + dt.timedelta(n)] = k
    assert all(r.customer_key == (best.get((r["Customer ID"], r["Order Date"])) if r["Customer ID"] else None) for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_a_late_month_is_computed_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark))
    assert summaries.refresh_changed(store) == dict.fromkeys(summaries.MONTHS)
    first = {(r.table_name, r.bucket): r.path for r in store.parts().collect()}
    load_all(store, silver(spark, [LATER[0], changed(ROWS[2], Row_ID="31", Order_ID="ORD-77-9", Order_Date="2022-06-20", Ship_Date="2022-06-21")]))
    assert summaries.refresh_changed(store) == dict.fromkeys(summaries.MONTHS, [202206, 202302])
    parts = {(r.table_name, r.bucket): r.path for r in store.parts().collect()}
    kept = [("mv_monthly_sales", 202205), ("mv_product_months", 202205)]
    assert all(parts[k] == first[k] for k in kept) and parts["mv_monthly_sales", 202206] != first["mv_monthly_sales", 202206]
    whole = WarehouseStar(store.tables())
    for name, build in summaries.SUMMARIES.items():
        assert rows_of(store.read(name)) == rows_of(build(whole)), name
    scan = fact_scan(summaries.monthly_sales(summaries.star_of_months(store.load(), [202302])))
    assert "2023" in scan.split("PartitionFilters")[1] and "GreaterThanOrEqual(order_date_key,20230200)" in scan
    assert summaries.refresh_changed(store) == dict.fromkeys(summaries.MONTHS, [])
    summaries.refresh_changed(store, dt.date(2024, 1, 1), keep_years=2)
    assert {r.bucket for r in store.parts().where("table_name = 'mv_monthly_sales'").collect()} == {202302}
    summaries.refresh_summaries(store, whole)
    assert summaries.refresh_changed(store) == {"mv_monthly_sales": None, "mv_product_months": []}


def test_orders_and_customers_without_expand(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark, [*ROWS, *LATER, changed(ROWS[0], Row_ID="41", Order_ID="ORD-77-2", Customer_ID="NEW-1", Customer_Name="Una New", Product_ID="XX-1")]))
    kpi = analytics.get_kpis(WarehouseStar(store.tables()))
    assert (kpi.first().total_orders, kpi.first().total_customers) == (4, 3)
    assert "Expand" not in kpi._jdf.queryExecution().optimizedPlan().toString()
    estimate = summaries.distinct_estimates(summaries.distinct_sketches(WarehouseStar(store.tables()))).first()
    assert tuple(estimate) == (4, 3)


def test_stored_rows_are_packed_tightly(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    store.create_tables()
    load_all(store, silver(spark))
    loading.stage(store, spark.createDataFrame(ROWS, RAW), silver(spark))
    for table in (FACTS, STAGING_RAW, STAGING_CLEAN):
        assert all(f.endswith(".zstd.parquet") for f in store.read(table).inputFiles()) and store.read(table).count() == 3
