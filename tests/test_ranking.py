import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillstar.operators.quantiles import exact_quantiles
from tillstar.operators.ranking import with_ntile, with_rank, with_row_number


def values(n=997, hot=0.34, seed=3):
    """A third of the rows share one value."""
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 60, n)
    v[rng.random(n) < hot] = 17
    return pd.DataFrame({"k": np.arange(n), "g": rng.choice(["a", "b"], n, p=[0.8, 0.2]), "v": v})


@pytest.fixture(scope="module")
def pdf():
    return values()


@pytest.fixture
def df(spark, pdf):
    return spark.createDataFrame(pdf, "k bigint, g string, v bigint").repartition(7)


def test_row_number(df, pdf):
    out = {r.k: r.n for r in with_row_number(df, (F.desc("v"), "k"), "n").collect()}
    expected = pdf.sort_values(["v", "k"], ascending=[False, True])["k"].tolist()
    assert [k for k, _ in sorted(out.items(), key=lambda kv: kv[1])] == expected
    assert sorted(out.values()) == list(range(1, len(pdf) + 1))


@pytest.mark.parametrize("rows", [997, 1000, 3, 1])
def test_ntile_matches_spark(spark, df, rows):
    part = df.filter(F.col("k") < rows)
    mine = {r.k: r.t for r in with_ntile(part, 4, (F.desc("v"), "k"), "t").collect()}
    part.createOrReplaceTempView("ntile_rows")
    theirs = spark.sql("SELECT k, ntile(4) OVER (ORDER BY v DESC, k) AS t FROM ntile_rows")
    assert mine == {r.k: r.t for r in theirs.collect()}


@pytest.mark.parametrize("within", [(), ("g",)])
@pytest.mark.parametrize("dense", [True, False])
def test_rank_matches_spark(spark, df, within, dense):
    mine = {r.k: r.r for r in with_rank(df, "v", "r", within=within, dense=dense).collect()}
    df.createOrReplaceTempView("rank_rows")
    part = f"PARTITION BY {', '.join(within)}" if within else ""
    name = "dense_rank" if dense else "rank"
    theirs = spark.sql(f"SELECT k, {name}() OVER ({part} ORDER BY v DESC) AS r FROM rank_rows")
    assert mine == {r.k: r.r for r in theirs.collect()}


def test_quantiles_match_pandas(df, pdf):
    amounts = df.select((F.col("v") / 4).cast("decimal(18,4)").alias("v"), F.col("k").cast("decimal(18,4)").alias("k"))
    out = {r.column_name: r for r in exact_quantiles(amounts, ("v", "k"), ("0.1", "0.25", "0.75")).collect()}
    for p, name in ((0.1, "q10"), (0.25, "q25"), (0.75, "q75")):
        assert float(out["v"][name]) == pytest.approx((pdf["v"] / 4).quantile(p), abs=1e-6)
        assert float(out["k"][name]) == pytest.approx(pdf["k"].quantile(p), abs=1e-6)


def test_no_window_sees_every_row(df):
    plan = with_ntile(df, 4, ("v", "k"), "t")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    # the only window without partitions runs over one row per sort partition
    assert plan.count("Exchange SinglePartition") <= 1
