import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import quantiles


def want(values, p):
    values = sorted(values)
    rank = Decimal(p) * (len(values) - 1)
    low = values[int(rank)]
    high = values[int(rank) + (rank > int(rank))]
    return low + (high - low) * (rank - int(rank))


@pytest.mark.parametrize("few", [3, 40])
def test_selection_against_a_sort(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    draw = random.Random(few)
    rows = [(Decimal(draw.randrange(-10**6, 10**6)) / 100, Decimal(7) if k % 3 else Decimal(draw.randrange(100)), None if k % 2 else Decimal(k)) for k in range(3001)]
    df = spark.createDataFrame(rows, "a decimal(18,4), b decimal(18,4), c decimal(18,4)")
    asked = ("0", "0.01", "0.25", "0.333", "0.5", "0.75", "0.999", "1")
    got = {r.column_name: r for r in quantiles.exact_quantiles(df, ("a", "b", "c"), asked).collect()}
    for i, c in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        for p in asked:
            assert abs(got[c][quantiles.quantile_name(p)] - want(values, p)) <= Decimal("0.000001"), (c, p)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 10)
    df = spark.range(5000).select(F.col("id").cast("decimal(18,4)").alias("a"))
    told = []
    real = quantiles._narrowed

    def narrow(values, open_):
        for b in open_:
            if not told:
                b.first += 1000  # the first sketch looks beside the rank
        real(values, open_)
        for b in open_:
            if not told:
                b.first -= 1000
                if b.low is not None and b.below > b.first:
                    b.low = b.high = None
                    b.below, b.rows, b.values = 0, 5000, 5000
        told.append(True)

    monkeypatch.setattr(quantiles, "_narrowed", narrow)
    assert quantiles.exact_quantiles(df, ("a",), ("0.5",)).first().q50 == Decimal("2499.5") and len(told) > 1


def test_no_sort_of_all_values(spark):
    df = spark.range(400_000).select((F.hash("id") % 10_000_000).cast("decimal(18,4)").alias("a"), F.lit(None).cast("decimal(18,4)").alias("n"))
    out = quantiles.exact_quantiles(df, ("a", "n"), ("0.25",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    (row,) = out.collect()
    assert row.column_name == "a" and row.q25 == Decimal(df.selectExpr("percentile(a, 0.25)").first()[0]).quantize(Decimal("0.000001"))
    assert quantiles.exact_quantiles(df, ("n",), ("0.25",)).count() == 0
