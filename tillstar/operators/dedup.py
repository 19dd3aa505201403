"""First-of-group selection and duplicate flags that survive a very large group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import materialize


def id_order(text: Column, descending: bool = False) -> list[tuple[Column, bool]]:
    """Ids of digits by number, whatever their length; after them, in either direction, the others by text.

    One text to sort by: without leading zeros the longer of two numbers is the larger, so its length stands first, in
    ten digits. Equal numbers written differently go by text.
    """
    digits = (F.translate(text, "0123456789", "") == "") & (text != "")
    plain = F.ltrim(text, F.lit("0"))
    before, behind = ("1", "0") if descending else ("0", "1")
    number = F.concat(F.lit(before), F.lpad(F.char_length(plain).cast("string"), 10, "0"), plain, text)
    return [(F.when(digits, number).otherwise(F.concat(F.lit(behind), text)), descending)]


Order = Sequence[tuple[Column, bool]]  # expression and whether it descends; NULL comes last


def row_order(df: DataFrame, row_id: str = "Row ID") -> Order:
    """File order: row ids of digits by number, others by text."""
    if row_id not in df.columns:
        return [(F.col(f"`{c}`"), False) for c in df.columns]
    return id_order(F.col(f"`{row_id}`"))


#: So many rows are sorted at a time before the shuffle, and so many are kept of them.
_HELD = 50_000


def _firsts(rows: pa.Table, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> pa.Table:
    rows = rows.sort_by(list(order)).append_column("_place", pa.array(range(rows.num_rows), pa.int64()))
    return rows.take(rows.group_by(list(keys), use_threads=False).aggregate([("_place", "min")]).column("_place_min")).drop_columns(["_place"])


def _combined(ordered: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """The first row per key of each stretch of rows; a task holds at most some ``_HELD`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh = [], 0
        for batch in batches:
            held.append(batch)
            fresh += batch.num_rows
            if fresh >= _HELD:
                kept = _firsts(pa.Table.from_batches(held), keys, order)
                held, fresh = kept.to_batches(), 0
                if kept.num_rows > _HELD // 2:  # hardly any row shares its key
                    yield from held
                    held = []
        if held:
            yield from _firsts(pa.Table.from_batches(held), keys, order).to_batches()

    return ordered.mapInArrow(run, ordered.schema)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order, combine: bool = False) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark keeps only the first row per key of each map task before the shuffle
    (WindowGroupLimit), so a key with very many rows does not meet in one task.
    The sort columns are computed once per row, not in every comparison. With ``combine``, for keys that have many rows each, the rows are thinned in
    small stretches before, so that no task sorts, and spills, all of its rows.
    """
    names = [f"_order_{i}" for i in range(len(order))]
    ordered = df.withColumns({n: expression for n, (expression, _) in zip(names, order)})
    if combine:
        ordered = _combined(ordered, keys, [(n, "descending" if down else "ascending") for n, (_, down) in zip(names, order)])
    by = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, (_, down) in zip(names, order)]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*by)
    return ordered.withColumn("_first", F.row_number().over(window)).filter("_first = 1").drop("_first", *names)


#: Bits of a key's hash that are counted. Fewer shuffle less; two keys that share them only take the longer way, some 42,000 rows of 216 M.
_KEY_BITS = 40


def _by_hash(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` whose hash ``key`` occurs once, and the others; None if there are none. Only hashes are shuffled to tell."""
    repeated = materialize(df.groupBy(key.alias("_repeated")).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1").select("_repeated"))
    if repeated.isEmpty():
        return df, None
    return df.join(repeated, key == F.col("_repeated"), "left_anti"), df.join(repeated, key == F.col("_repeated"), "left_semi")


def remove_duplicates(df: DataFrame, keys: Sequence[str] = ("Order ID", "Product ID")) -> DataFrame:
    """Keep the first row of each business key, or of each full row without one.

    Hashes of the keys are counted first, so that only rows whose hash occurs again are shuffled and sorted as a whole; the others pass where they are.
    """
    if not all(k in df.columns for k in keys):
        return df.distinct()
    alone, again = _by_hash(df, F.xxhash64(*[F.col(f"`{k}`") for k in keys]).bitwiseAND(F.lit((1 << _KEY_BITS) - 1)))
    return alone if again is None else alone.unionByName(first_per_key(again, keys, row_order(df)))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows ``copies``."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Column, name: str = "_is_duplicate") -> DataFrame:
    """Flag every row of a key but its first in ``order``, which must be unique.

    The first value per repeated key is aggregated with map-side combine and joined back;
    in that join AQE splits a key with very many rows. NULL keys count as equal.
    """
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    firsts = (
        df.groupBy(*[F.col(f"`{k}`").alias(a) for k, a in named.items()])
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    firsts = materialize(firsts)  # else its grouping is the join's partitioning and a large key cannot be split
    same = None
    for k, a in named.items():
        test = F.col(f"`{k}`").eqNullSafe(F.col(a))
        same = test if same is None else same & test
    later = F.col("_first").isNotNull() & (order != F.col("_first"))
    joined = df.join(firsts, same, "left")
    return joined.withColumn(name, later).select(*[F.col(f"`{c}`") for c in df.columns], name)


_CHUNK = 100_000


def flag_exact_duplicates(df: DataFrame, name: str = "_is_duplicate", stored: bool = False) -> DataFrame:
    """Flag all but one of fully equal rows.

    Hashes of the rows are counted first, so that only rows whose hash occurs again are shuffled. Equal rows cannot be told apart, so these are counted and
    written out again: one unflagged, the others flagged, in chunks that spread over tasks. With ``stored``, for several readers, the result is written once
    if any hash occurs again; else it is ``df`` itself with a flag.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    alone, again = _by_hash(df, F.xxhash64(*columns))  # all bits: rows that only share some would have all be stored once more
    passed = alone.select(*columns, F.lit(False).alias(name))
    if again is None:
        return passed
    counted = materialize(again.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")))
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 2) / _CHUNK)))
    repeated = (
        counted.filter("_copies > 1").withColumn("_chunk", chunks)
        .repartition(*columns, "_chunk")
        .withColumn("_size", F.least(F.lit(_CHUNK), F.col("_copies") - 1 - F.col("_chunk") * _CHUNK).cast("int"))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col("_size"))))
        .select(*columns, F.lit(True).alias(name))
    )
    flagged = passed.unionByName(counted.select(*columns, F.lit(False).alias(name))).unionByName(repeated)
    return materialize(flagged) if stored else flagged
