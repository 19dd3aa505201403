import datetime as dt
import hashlib
import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from tillstar.functions import dates, numbers, text

NAMES = ["o'neil-smith", "  new  york ", "3rd street", "ALL CAPS", "mcDonald", "a1b2", "", "x", "são paulo", "l'ÎLE d'Or",
         "Los Angeles", "New-York 2Nd", "McD", "Éa B", "aB", "A1b", "X_y", " "]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(df, expression):
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


def test_title_case_matches_python(spark):
    assert apply(column(spark, NAMES), text.title_case(F.col("v"))) == [n.title() for n in NAMES]


def test_strip_matches_python(spark):
    values = ["  a ", "\t\nb\r", "\xa0c ", "", " ", "d e", "f\n", "\x1cg", None, "line\nbreak", "　é"]
    assert apply(column(spark, values), text.strip(F.col("v"))) == [v if v is None else v.strip() for v in values]


def test_canonical_names(spark):
    df = column(spark, ["furniture", "officesupplies", " TECH", "garden tools"])
    assert apply(df, text.category_name(F.col("v"))) == ["Furniture", "Office Supplies", "Technology", "Garden Tools"]
    df = column(spark, ["w", " East ", "NORTH"])
    assert apply(df, text.region_name(F.col("v"))) == ["West", "East", "North"]
    df = column(spark, ["US", "USA ", "us", "Canada"])
    assert apply(df, text.country_name(F.col("v"))) == ["United States", "United States", "us", "Canada"]


def test_postal_code_keeps_zeros(spark):
    df = column(spark, ["02108", "90024.0", "nan", None, "K1A 0B1"])
    assert apply(df, text.postal_code(F.col("v"))) == ["02108", "90024", "Unknown", "Unknown", "K1A 0B1"]


def test_hash_key(spark):
    df = spark.createDataFrame([("US-1", "F-1"), ("US-1", None)], "a string, b string")
    for digits, key in ((64, text.hash_key(F.col("a"), F.col("b"))), (16, text.hash_key(F.col("a"), F.col("b"), digits=16))):
        assert [r[0] for r in df.select(key).collect()] == [hashlib.sha256(s.encode()).hexdigest()[:digits] for s in ("US-1|F-1", "US-1|None")]
    with pytest.raises(ValueError):
        text.hash_key()


def test_clean_string_composes(spark):
    values = ["  Café ", "   ", None, "plain"]
    expected = [None if v is None else (unicodedata.normalize("NFC", v.strip()) or None) for v in values]
    assert apply(column(spark, values), text.clean_string(F.col("v"))) == expected


def test_category_code(spark):
    df = spark.createDataFrame([("Office Supplies", "Storage Bins"), ("Art", "X")], "c string, s string")
    out = [r[0] for r in df.select(text.category_code(F.col("c"), F.col("s"))).collect()]
    assert out == ["OFFI-STORAGEBINS", "ART-X"]


def test_dates(spark):
    df = column(spark, ["2024-01-15", "2024/01/15", "01/15/2024", "15-01-2024"])
    assert apply(df, dates.date_key_from_text(F.col("v"))) == [20240115] * 4
    with pytest.raises(Exception, match="not a date"):
        apply(column(spark, ["soon"]), dates.date_key_from_text(F.col("v")))
    assert apply(column(spark, ["soon"]), dates.date_key_from_text(F.col("v"), strict=False)) == [None]
    days = [dt.date(2024, 3, 31), dt.date(2024, 4, 1), dt.date(2023, 12, 31)]
    df = column(spark, days, "date")
    assert apply(df, dates.fiscal_quarter(F.col("v"))) == [4, 1, 3]
    assert apply(df, dates.fiscal_year(F.col("v"))) == [2023, 2024, 2023]
    assert apply(df, dates.iso_day_of_week(F.col("v"))) == [d.isoweekday() for d in days]


def test_numbers(spark):
    df = column(spark, [1234.5, None, math.nan, math.inf, -0.005], "double")
    assert apply(df, numbers.format_currency(F.col("v"))) [:4] == ["$1,234.50", "N/A", "N/A", "N/A"]
    df = column(spark, ["1.5", "x", "NaN", None], "string")
    assert apply(df, numbers.numeric(F.col("v"))) == [1.5, None, None, None]
    df = spark.createDataFrame([(10.0, 3.0), (10.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.safe_divide(F.col("a"), F.col("b"))).collect()] == [10 / 3, 0.0]


def test_ratio_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST(10.05 AS DECIMAL(38,2)) AS a, 2 AS b UNION ALL SELECT -10.05, 2 UNION ALL SELECT 1, 0")
    out = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 2).cast("double")).collect()]
    assert out == [5.03, -5.03, None]
