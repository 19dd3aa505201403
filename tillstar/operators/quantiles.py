"""Exact quantiles with linear interpolation, and outlier flags built on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import materialize

#: A bracket with at most so many different values is sorted, in one window.
FEW = 100_000
#: Sketches are wrong by a rank of at most one in so many rows.
ACCURACY = 10_000


@dataclass
class _Bracket:
    """Values from ``low`` to ``high`` (None: all) of ``column``, which hold the ranks ``first`` to ``last``; ``below`` rows are less."""

    column: str
    probability: str
    first: int
    last: int
    part: Decimal
    rows: int
    values: int
    low: Decimal | None = None
    high: Decimal | None = None
    below: int = 0
    spread: float = 2 / ACCURACY

    def holds(self) -> Column:
        value = F.col(self.column)
        return value.isNotNull() if self.low is None else value.between(F.lit(self.low), F.lit(self.high))


def _narrowed(values: DataFrame, open_: list[_Bracket]) -> None:
    """One sketch of each bracket's values around its ranks, then one exact count; a bracket that misses its ranks stays and is sketched wider."""
    def around(b: _Bracket) -> list[float]:
        low, high = (max(0, rank - b.below) / max(1, b.rows - 1) for rank in (b.first, b.last))
        return [max(0.0, low - b.spread), min(1.0, high + b.spread)]

    told = values.agg(*[F.percentile_approx(F.when(b.holds(), F.col(b.column)), around(b), ACCURACY).alias(f"e{i}") for i, b in enumerate(open_)]).first()
    tests = []
    for i, b in enumerate(open_):
        value, low, high = F.col(b.column), F.lit(told[i][0]), F.lit(told[i][1])
        tests += [F.count_if(value < low).alias(f"b{i}"), F.count_if(value <= high).alias(f"u{i}"),
                  F.approx_count_distinct(F.when(value.between(low, high), value)).alias(f"v{i}")]
    counts = values.agg(*tests).first()
    for i, b in enumerate(open_):
        below, upto, different = counts[f"b{i}"], counts[f"u{i}"], counts[f"v{i}"]
        if below <= b.first and b.last < upto:
            b.low, b.high, b.below, b.rows, b.values = told[i][0], told[i][1], below, upto - below, different
        else:
            b.spread *= 4


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[str]) -> DataFrame:
    """One row per column that has a value: ``column_name`` and ``q<percent>`` for each probability.

    ``percentile`` would hold every distinct value of a column in one buffer, and a sort would move all of them. Here mergeable sketches bracket the ranks,
    the rows below and inside are counted exactly, and only the few values inside are put in order. A value on a third of
    the rows is one of them. Columns must share one decimal type; probabilities are texts such as ``"0.25"``.
    """
    values = materialize(df.select(*columns))
    counts = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    brackets = []
    for c in columns:
        for p in probabilities if counts[c] else ():
            rank = Decimal(p) * (counts[c] - 1)
            first = int(rank)
            brackets.append(_Bracket(c, p, first, first + (rank > first), rank - first, counts[c], counts[c]))
    while open_ := [b for b in brackets if b.values > FEW and (b.low is None or b.low != b.high)]:
        _narrowed(values, open_)

    kind = values.schema[columns[0]].dataType
    shape = ", ".join(["column_name string", *[f"{quantile_name(p)} decimal(18,6)" for p in probabilities]])
    if not brackets:
        return df.sparkSession.createDataFrame([], shape)
    inside = F.array_compact(F.array(*[F.when(b.holds(), F.struct(F.lit(i).alias("bracket"), F.col(b.column).alias("value"))) for i, b in enumerate(brackets)]))
    kept = values.select(F.explode(inside).alias("_in")).select("_in.*").groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("value"))
    sides = []
    for i, b in enumerate(brackets):
        sides += [F.when(F.col("bracket") == i, F.struct(*[F.lit(v).alias(n) for n, v in (
            ("column_name", b.column), ("probability", b.probability), ("first", b.first - b.below), ("last", b.last - b.below))],
            F.lit(b.part).cast("decimal(6,4)").alias("part")))]
    ranked = kept.withColumn("upto", upto).withColumn("of", F.coalesce(*sides))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("upto") - F.col("n") <= F.col(f"of.{rank}")) & (F.col(f"of.{rank}") < F.col("upto")), F.col("value"))).cast(kind)

    picked = ranked.groupBy("of.column_name", "of.probability").agg(at("first").alias("low"), at("last").alias("high"), F.max("of.part").alias("part"))
    exact = (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).cast("decimal(18,6)")
    return picked.groupBy("column_name").agg(*[F.max(F.when(F.col("probability") == p, exact)).alias(quantile_name(p)) for p in probabilities])


def quantile_name(probability: str) -> str:
    """``"0.25"`` names the column ``q25``."""
    return f"q{(Decimal(probability) * 100).normalize():f}".replace(".", "_")


def outlier_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """``column_name, lower_bound, upper_bound``: quartiles widened by ``k`` times their distance."""
    if exact:
        quartiles = exact_quantiles(df, columns, ("0.25", "0.75"))
    else:
        wide = df.agg(*[F.percentile_approx(c, [0.25, 0.75], 10_000).alias(c) for c in columns])
        long = wide.unpivot([], list(columns), "column_name", "q")
        quartiles = long.select("column_name", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q75"))
    spread = (F.col("q75") - F.col("q25")) * F.lit(Decimal(str(k)))
    return quartiles.select("column_name", (F.col("q25") - spread).alias("lower_bound"),
                            (F.col("q75") + spread).alias("upper_bound"))


def detect_outliers(df: DataFrame, columns: Sequence[str] = ("Sales", "Quantity", "Profit"), k: float = 1.5,
                    exact: bool = True) -> DataFrame:
    """Add ``is_outlier``: any of ``columns`` outside its bounds. A NULL is no outlier."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.withColumn("is_outlier", F.lit(False))
    amounts = df.select(*[F.col(c).cast("decimal(18,4)").alias(c) for c in present])
    bounds = outlier_bounds(amounts, present, k, exact)
    # Two numbers per column, the only values that pass through the driver.
    limits = {r.column_name: (r.lower_bound, r.upper_bound) for r in bounds.collect()}
    tests = [
        F.coalesce((F.col(c) < F.lit(limits[c][0])) | (F.col(c) > F.lit(limits[c][1])), F.lit(False))
        for c in present if c in limits
    ]
    return df.withColumn("is_outlier", reduce(lambda a, b: a | b, tests, F.lit(False)))
