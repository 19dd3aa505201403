"""Positions, tiles and ranks over a whole table without a one-task window.

``OVER (ORDER BY ...)`` alone sends every row to one task. Here the rows are
range-sorted into partitions and stored once; each row then knows its place in
its partition, and one small row per partition says how many rows come before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import materialize

_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in the low 33 bits


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Sorted rows with their partition ``_part`` and place ``_at`` in it, stored."""
    sorted_rows = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    return materialize(sorted_rows).withColumns({
        "_part": F.shiftright("_slot", _PLACE_BITS),
        "_at": F.col("_slot").bitwiseAND((1 << _PLACE_BITS) - 1),
    }).drop("_slot")


def _with_offsets(placed: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Add ``_before`` (rows, or weight, in earlier partitions) and ``_all``.

    The per-partition table has at most as many rows as the sort had partitions,
    which bounds both its window and its broadcast.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    parts = placed.groupBy("_part").agg(size.alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_all"),
    )
    return placed.join(F.broadcast(offsets), "_part")


def with_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_number") -> DataFrame:
    """Number rows 1..N in ``order``, which should end in a unique column."""
    numbered = _with_offsets(_placed(df, order))
    return numbered.withColumn(name, F.col("_before") + F.col("_at") + 1).select(*df.columns, name)


def with_ntile(df: DataFrame, tiles: int, order: Sequence[Column | str], name: str) -> DataFrame:
    """NTILE over the whole table: the first N mod ``tiles`` tiles get one row more."""
    numbered = _with_offsets(_placed(df, order))
    at = F.col("_before") + F.col("_at")
    small = F.floor(F.col("_all") / tiles)
    in_large = (F.col("_all") % tiles) * (small + 1)
    tile = F.when(at < in_large, F.floor(at / (small + 1))).otherwise(
        F.col("_all") % tiles + F.floor(F.try_divide(at - in_large, small)))
    return numbered.withColumn(name, (tile + 1).cast("int")).select(*df.columns, name)


def value_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Distinct ``keys`` in ``order`` with ``_n`` rows each and ``_rows_before``, ``_values_before``.

    Counting first keeps a value shared by very many rows to a single row.
    """
    placed = _placed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), order)
    rows = _with_offsets(placed, weight="_n").withColumnsRenamed({"_before": "_rows_earlier", "_all": "_row_total"})
    both = _with_offsets(rows)
    in_part = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return both.select(
        *keys, "_n",
        (F.col("_rows_earlier") + F.coalesce(F.sum("_n").over(in_part), F.lit(0))).alias("_rows_before"),
        (F.col("_before") + F.col("_at")).alias("_values_before"),
    )


def with_rank(df: DataFrame, value: str, name: str, *, within: Sequence[str] = (), descending: bool = True,
              dense: bool = True) -> DataFrame:
    """RANK or DENSE_RANK of ``value``, over the table or ``within`` groups.

    A group may be of any size: its rows are spread over many partitions.
    ``df`` is stored first because it is read twice.
    """
    stored = materialize(df)
    direction = F.desc(value) if descending else F.asc(value)
    places = value_positions(stored.select(*within, value), (*within, value), (*within, direction))
    before = "_values_before" if dense else "_rows_before"
    if within:
        starts = places.groupBy(*within).agg(F.min(before).alias("_start"))
        places = places.join(starts, list(within))
        rank = F.col(before) - F.col("_start") + 1
    else:
        rank = F.col(before) + 1
    ranks = places.select(*within, value, rank.cast("bigint").alias(name))
    return stored.join(ranks, [*within, value]).select(*df.columns, name)
