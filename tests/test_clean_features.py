import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import ROWS, changed
from tillstar.operators import clean, dedup, features
from tillstar.schemas import RAW


def test_trim(spark):
    df = spark.createDataFrame([("  John Smith  ",), ("Jane Doe   ",), ("  Bob",), (None,)], "`Customer Name` string")
    assert [r[0] for r in clean.trim_whitespace(df).collect()] == ["John Smith", "Jane Doe", "Bob", None]


def test_missing_values(spark):
    rows = [*ROWS, changed(ROWS[0], Sales=None, Profit=None, Postal_Code=None), changed(ROWS[0], Row_ID="5", Postal_Code=None)]
    out = clean.handle_missing_values(spark.createDataFrame(rows, RAW))
    assert out.count() == 4
    assert out.filter("`Row ID` = '5'").first()["Postal Code"] == "Unknown"


def test_invalid_records(spark):
    day = lambda d: dt.date(2022, 1, d)
    rows = [(1, Decimal("0.1"), day(1), day(5)), (-5, Decimal("0.2"), day(5), day(1)), (3, Decimal("1.5"), day(5), day(1)), (4, None, day(1), day(2))]
    df = spark.createDataFrame(rows, "Quantity int, Discount decimal(5,2), `Order Date` date, `Ship Date` date")
    assert [r.Quantity for r in clean.remove_invalid_records(df).collect()] == [1]


def test_types(spark):
    rows = [changed(ROWS[0], Sales="abc", Quantity="2.0", Order_Date="05/10/2022", Postal_Code="90012.0")]
    out = clean.fix_data_types(spark.createDataFrame(rows, RAW)).first()
    assert (out.Sales, out.Quantity, out["Order Date"], out["Postal Code"]) == (None, 2, None, "90012")
    both = clean.fix_data_types(spark.createDataFrame(rows, RAW), ("yyyy-MM-dd", "MM/dd/yyyy")).first()
    assert both["Order Date"] == dt.date(2022, 5, 10)


def test_first_of_key_follows_row_number(spark):
    rows = [changed(ROWS[0], Row_ID="10", Sales="1"), changed(ROWS[0], Row_ID="9", Sales="2"), changed(ROWS[0], Row_ID="x", Sales="3")]
    assert [r.Sales for r in dedup.remove_duplicates(spark.createDataFrame(rows, RAW)).collect()] == ["2"]
    assert dedup.remove_duplicates(spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b string")).count() == 2


def test_first_of_key_is_cut_before_the_shuffle(spark):
    plan = dedup.remove_duplicates(spark.createDataFrame(ROWS * 3, RAW))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_duplicate_flags(spark):
    rows = [(1, "a", None), (2, "a", None), (3, "b", None), (4, "a", "x"), (5, "a", None)]
    df = spark.createDataFrame(rows, "i int, k string, l string")
    out = {r.i: r.dup for r in dedup.flag_duplicates(df, ("k", "l"), F.col("i"), "dup").collect()}
    assert out == {1: False, 2: True, 3: False, 4: False, 5: True}


def test_exact_duplicates_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "_CHUNK", 3)
    df = spark.createDataFrame([("hot", None)] * 11 + [("b", 1)] * 2 + [("c", 2)], "k string, n int")
    out = dedup.flag_exact_duplicates(df, "dup").groupBy("k").agg(
        F.count("*").alias("n"), F.count_if("dup").alias("d")).collect()
    assert {(r.k, r.n, r.d) for r in out} == {("hot", 11, 10), ("b", 2, 1), ("c", 1, 0)}


def test_only_rows_that_occur_again_are_shuffled_to_flag_them(spark, monkeypatch):
    written, store = [], dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df: written.append(store(df)) or written[-1])
    rows = [changed(ROWS[k % 3], Row_ID=str(k), City=None if k % 4 else "") for k in range(30)]
    alone = dedup.flag_exact_duplicates(spark.createDataFrame(rows, RAW).repartition(3), "dup", stored=True)
    assert alone.filter("NOT dup").count() == 30 and len(written) == 1  # the hashes that repeat, and no copy of the rows
    written.clear()
    twice = spark.createDataFrame([*rows, *rows[:2], rows[0]], RAW)
    out = dedup.flag_exact_duplicates(twice, "dup", stored=True)
    assert [written[0].count(), written[1].count(), written[2].count()] == [2, 2, 33]
    assert sorted((r["Row ID"], r.dup) for r in out.collect()) == sorted([(str(k), False) for k in range(30)] + [("0", True), ("0", True), ("1", True)])


def test_features(raw):
    rows = features.engineer_features(clean.fix_data_types(raw)).orderBy("Row ID").collect()
    assert [r.Revenue for r in rows[:2]] == [Decimal("250.00"), Decimal("108.00")]
    assert [r.Profit_Margin for r in rows[:2]] == [Decimal("0.2000"), Decimal("0.0833")]
    first = rows[0]
    assert (first.Order_Year, first.Order_Month_Name, first.Order_to_Ship_Days) == (2022, "May", 4)
    assert (first.Order_Day_of_Week, first.Order_Day_Name) == (1, "Tuesday")


def test_margin_limits(spark):
    df = spark.createDataFrame([(Decimal("0.01"), Decimal("-50")), (Decimal("1"), Decimal("9")), (Decimal("0"), Decimal("9"))],
                               "Sales decimal(12,2), Profit decimal(12,2)")
    out = features.engineer_features(df).collect()
    assert [r.Profit_Margin for r in out] == [Decimal("-10.0000"), Decimal("1.0000"), Decimal("0.0000")]
    assert [r.Order_to_Ship_Days for r in out] == [-1, -1, -1]


def test_categories(spark):
    df = spark.createDataFrame([("furniture", "bookcases"), ("officesupplies", "binders"), ("technology", "phones"), ("tech", "copiers")],
                               "Category string, `Sub-Category` string")
    out = features.normalize_categories(df).collect()
    assert [r.Category for r in out] == ["Furniture", "Office Supplies", "Technology", "Technology"]
    assert [r["Sub-Category"] for r in out] == ["Bookcases", "Binders", "Phones", "Copiers"]


def test_outliers(spark):
    df = spark.createDataFrame([(Decimal(v), 1) for v in (1, 2, 3, 4, 100)] + [(None, 1)], "Sales decimal(12,2), Quantity int")
    out = features.detect_outliers(df, ("Sales", "Quantity")).collect()
    assert [r.is_outlier for r in out if r.Sales is not None] == [False] * 4 + [True]
    assert [r.is_outlier for r in out if r.Sales is None] == [False]
    near = features.detect_outliers(df, ("Sales",), exact=False)
    assert near.filter("is_outlier").count() == 1
