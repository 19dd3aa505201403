"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.dedup import Order, first_per_key, id_order
from tillstar.operators.dimensions import assign_keys
from tillstar.operators.ranking import with_row_number
from tillstar.session import materialize


def _differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [~l.eqNullSafe(r) for l, r in zip(left, right)])


def scd2_history(changes: DataFrame, key: str, attributes: Sequence[str], date: str, order: Order) -> DataFrame:
    """Every change in date order as a version.

    The last row per key and day counts (``order`` breaks ties, last wins). A key
    then has at most one row per day, which bounds the windows. Result: ``key``,
    ``attributes``, ``effective_date``, ``expiry_date``, ``is_current``.
    """
    daily = first_per_key(changes, (key, date), order)
    in_time = Window.partitionBy(key).orderBy(date)
    earlier = [F.lag(a).over(in_time) for a in attributes]
    first = F.row_number().over(in_time) == 1
    changed = daily.withColumn("_starts", first | _differs([F.col(a) for a in attributes], earlier)).filter("_starts")
    following = F.lead(date).over(in_time)
    return changed.select(
        key, *attributes, F.col(date).alias("effective_date"),
        F.date_sub(following, 1).alias("expiry_date"), following.isNull().alias("is_current"))


def scd2_apply_batch(existing: DataFrame, batch: DataFrame, key: str, attributes: Sequence[str], date: str,
                     order: Order, surrogate: str) -> tuple[DataFrame, DataFrame]:
    """Apply the latest row per key of ``batch`` to the stored versions.

    A new key gets a current version from its date. A changed key closes its
    current version the day before and gets a new one. Returns the whole new
    snapshot and, of it, the inserted rows. ``order`` puts the latest row first.
    """
    latest = first_per_key(batch.na.drop(subset=[key]), (key,), order).select(
        key, *[F.col(a).alias(f"_new_{a}") for a in attributes], F.col(date).alias("_new_date"), F.lit(True).alias("_seen"))
    current = existing.filter("is_current")
    joined = current.join(latest, key, "full_outer")
    is_new = F.col(surrogate).isNull()
    is_changed = ~is_new & F.col("_seen").isNotNull() & _differs(
        [F.col(a) for a in attributes], [F.col(f"_new_{a}") for a in attributes])
    # Read three times below, so the outcome of the join is stored once.
    staged = materialize(joined.withColumns({"_is_new": is_new, "_is_changed": is_changed}))

    columns = existing.columns
    kept = staged.filter("NOT _is_new").withColumns({
        "is_current": F.col("is_current") & ~F.col("_is_changed"),
        "expiry_date": F.when(F.col("_is_changed"), F.date_sub("_new_date", 1)).otherwise(F.col("expiry_date")),
        "updated_at": F.when(F.col("_is_changed"), F.current_timestamp()).otherwise(F.col("updated_at")),
    }).select(*columns)
    started = staged.filter("_is_new OR _is_changed").select(
        key, *[F.col(f"_new_{a}").alias(a) for a in attributes], F.col("_new_date").alias("effective_date"))
    inserted = assign_keys(started, surrogate, (key,), existing).withColumns({
        "expiry_date": F.lit(None).cast("date"), "is_current": F.lit(True),
        "created_at": F.current_timestamp(), "updated_at": F.current_timestamp(),
    }).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema.fields])
    closed = existing.filter("NOT is_current")
    return closed.unionByName(kept).unionByName(inserted), inserted


def customer_changes(batch: DataFrame) -> DataFrame:
    """The customer columns of prepared order lines under their dimension names."""
    row = [F.col("Row ID").alias("row_id")] if "Row ID" in batch.columns else []
    return batch.na.drop(subset=["Customer ID", "Customer Name"]).select(
        F.col("Customer ID").alias("customer_id"), F.col("Customer Name").alias("customer_name"),
        F.col("Segment").alias("segment"), F.col("Order Date").alias("order_date"), *row)


def latest_first(changes: DataFrame) -> Order:
    """Latest date first; among equals the last row of the file."""
    order = [(F.col("order_date"), True)]
    if "row_id" in changes.columns:
        order += id_order(F.col("row_id"), descending=True)
    return order


def apply_customers(existing: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    changes = customer_changes(batch)
    return scd2_apply_batch(existing, changes, "customer_id", ("customer_name", "segment"), "order_date",
                            latest_first(changes), "customer_key")


def customer_history(batch: DataFrame) -> DataFrame:
    changes = customer_changes(batch)
    return scd2_history(changes, "customer_id", ("customer_name", "segment"), "order_date", latest_first(changes)[1:])


def splice(existing: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str], date: str, row: str | None,
           surrogate: str, largest: int) -> tuple[DataFrame, int]:
    """Put ``changes`` where their dates belong in the stored versions, however late they come.

    ``existing`` has each version's ``seen`` days. They are taken apart, joined by the changes (per key and day the last row by the number in ``row``
    counts, the newer one if equal), and runs of equal attributes become versions again. So any order of
    batches gives the history of all rows at once. A version keeps its surrogate key, also when it now begins earlier or
    a change cuts it in two; two stored versions never become one, because facts refer to both.
    A key has at most one row per day, which bounds the windows. Keys follow ``largest``.
    Returns all versions and how many are new.
    """
    names = [f.name for f in existing.schema.fields]
    days = F.coalesce("seen", F.array(F.struct(F.col("effective_date").alias("day"), F.lit(None).cast("string").alias("row"))))
    stamp = F.struct(F.col("effective_date").alias("start"), F.col(surrogate).alias("number"), "expiry_date", "is_current", "created_at", "updated_at",
                     F.struct(*attributes).alias("was"))
    old = existing.select(key, *attributes, stamp.alias("_stamp"), F.explode(days).alias("_seen")).select(
        key, *attributes, F.col("_seen.day").alias("_day"), F.col("_seen.row").alias("_row"), F.lit(False).alias("_new"),
        F.when(F.col("_seen.day") == F.col("_stamp.start"), F.col("_stamp")).alias("_stamp"))
    told = F.lit(None).cast("string") if row is None else F.col(row).cast("string")
    new = changes.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(
        key, *attributes, F.col(date).cast("date").alias("_day"), told.alias("_row"), F.lit(True).alias("_new"),
        F.lit(None).cast(old.schema["_stamp"].dataType).alias("_stamp"))
    rank = F.struct(id_order(F.col("_row"), descending=True)[0][0], F.col("_new"))
    daily = old.unionByName(new).groupBy(key, "_day").agg(
        F.max_by(F.struct(*attributes, "_row"), rank).alias("_last"), F.max("_stamp").alias("_stamp")).select(key, "_day", "_last.*", "_stamp")

    in_time = Window.partitionBy(key).orderBy("_day")
    changed = (F.row_number().over(in_time) == 1) | _differs([F.col(a) for a in attributes], [F.lag(a).over(in_time) for a in attributes])
    runs = daily.withColumn("_changed", changed).withColumn("_run", F.sum(F.col("_changed").cast("int")).over(in_time))
    stamps = F.count("_stamp").over(Window.partitionBy(key, "_run").orderBy("_day"))
    starts = F.col("_changed") | (F.col("_stamp").isNotNull() & (stamps > 1))
    numbered = runs.withColumn("_starts", starts).withColumn("_version", F.sum(F.col("_starts").cast("int")).over(in_time))
    versions = numbered.groupBy(key, "_version").agg(
        *[F.first(a).alias(a) for a in attributes], F.min("_day").alias("effective_date"), F.max("_stamp").alias("_stamp"),
        F.sort_array(F.collect_list(F.struct(F.col("_day").alias("day"), F.col("_row").alias("row")))).alias("seen"))
    following = F.lead("effective_date").over(Window.partitionBy(key).orderBy("effective_date"))
    staged = materialize(versions.withColumns({"expiry_date": F.date_sub(following, 1), "is_current": following.isNull()}))

    fresh = with_row_number(staged.where("_stamp IS NULL"), (key, "effective_date"), "_number")
    now = F.current_timestamp()
    same = F.struct("expiry_date", "is_current", F.col("effective_date"), F.struct(*attributes)).eqNullSafe(
        F.struct("_stamp.expiry_date", "_stamp.is_current", "_stamp.start", "_stamp.was"))
    kept = staged.where("_stamp IS NOT NULL").withColumns({
        surrogate: F.col("_stamp.number"), "created_at": F.col("_stamp.created_at"), "updated_at": F.when(same, F.col("_stamp.updated_at")).otherwise(now)})
    added = materialize(fresh.withColumns({surrogate: F.col("_number") + F.lit(largest), "created_at": now, "updated_at": now}))
    shape = [F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema.fields]
    return kept.select(*shape).unionByName(added.select(*shape)).select(*names), added.count()


def splice_customers(existing: DataFrame, lines: DataFrame, largest: int, daily: bool = False) -> tuple[DataFrame, int]:
    """:func:`splice` for the customers of prepared order lines: of each the latest row, or with ``daily`` the last of every day."""
    changes = customer_changes(lines)
    if not daily:
        changes = first_per_key(changes, ("customer_id",), latest_first(changes), combine=True)
    row = "row_id" if "row_id" in changes.columns else None
    return splice(existing, changes, "customer_id", ("customer_name", "segment"), "order_date", row, "customer_key", largest)


def collapsed(versions: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Versions without surrogate keys: neighbours that :func:`splice` kept apart for their keys, though a correction made them equal, are one."""
    in_time = Window.partitionBy(key).orderBy("effective_date")
    first = F.row_number().over(in_time) == 1
    starts = versions.withColumn("_starts", first | _differs([F.col(a) for a in attributes], [F.lag(a).over(in_time) for a in attributes])).filter("_starts")
    following = F.lead("effective_date").over(in_time)
    return starts.select(key, *attributes, "effective_date", F.date_sub(following, 1).alias("expiry_date"), following.isNull().alias("is_current"))
