"""Mixing sources to target weights by entropy balancing.

Each source has a token constraint: the sum of rate times size over its documents is the source's target. Among all
rates that meet the constraints and stay within [0, ``CAP``], those of least relative entropy to rate 1 are taken; a
document's entropy counts with size ** ``TEMPER``, hence the solution is the exponential tilt
``rate = min(CAP, exp(lambda_source * size ** (1 - TEMPER)))``. ``TEMPER`` 1 gives all documents of a source one rate, 0 is
plain entropy over documents. The dual is convex in one variable per source and is solved by Newton steps over the
histogram of sizes, all sources at once, with bisection where a step leaves the bracket.

Rates are rounded into copies: the whole part, and one more for documents whose hash lies below the fraction plus a
shift per source, the largest of 65,536 at which the words taken stay within the target; small documents then fill what is
missing, and
at last the one document that comes nearest to the rest gets one more.

Defined results: null text has size 0; a null source is a source of its own, last in the order; documents of size 0 are
copied once and take nothing; rows that repeat a ``doc_id`` count each, equal rows get equal copies; an empty table gives no rows; other
columns are kept by ``mix`` and cannot clash with those made here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstar.llm.tables import shielded
from tillstar.session import materialize

WEIGHTS = (5, 2, 1)
CAP = 3
TEMPER = 0.75
STEPS, EXACT = 60, 1e-7
_LOW, _HIGH = -50.0, 1.0986122886681098  # ln 3: at size 1 or more all documents are at the cap there
_SLOTS = 65_536


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size -> and target: shares by weight, at most CAP times the source's size, the excess reshared.

    In ascending order of cap over weight, a source stays at its cap if the rest, shared by weight, would give it more. The
    windows run over one row per source.
    """
    ranked = sources.withColumn("i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("i") % len(WEIGHTS) + 1).cast("int")).cast("double")
    whole = W.partitionBy()
    before = W.orderBy("ratio", "i").rowsBetween(W.unboundedPreceding, -1)
    table = (
        ranked.withColumns({"weight": weight, "cap": F.col("source_size") * float(CAP)}).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumns({"all": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole),
                      "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "weights_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
        .withColumn("level", (F.col("all") - F.col("caps_before")) / (F.col("weights") - F.col("weights_before")))
        .withColumn("capped", F.col("ratio") <= F.col("level"))
    )
    # The level that holds for all uncapped sources is that of the first of them.
    level = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(W.orderBy("ratio", "i").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return table.withColumn("at", level).select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("at")).alias("target"))


def _power(size: Column) -> Column:
    return F.pow(size.cast("double"), F.lit(1 - TEMPER))


def tilts(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, tilt: the dual solution of every source.

    ``cells`` has source, size, n: the documents of each size. A round is one join and aggregation over them and
    ends in a stored table with a row per source; sources that have converged stay as they are.
    """
    state = materialize(goals.withColumns({"tilt": F.lit(0.0), "low": F.lit(_LOW), "high": F.lit(_HIGH), "error": F.lit(1.0)}))
    used = cells.where("size > 0")
    for _ in range(STEPS):
        old = state.select(F.col("source").alias("s"), "tilt", "target")
        power = _power(F.col("size"))
        free = F.exp(F.col("tilt") * power) < CAP
        mass = F.col("n") * F.col("size") * F.least(F.exp(F.col("tilt") * power), F.lit(float(CAP)))
        sums = (
            used.join(old, F.col("source").eqNullSafe(F.col("s"))).groupBy("s")
            .agg(F.sum(mass).alias("f"), F.sum(F.when(free, mass * power).otherwise(0.0)).alias("df"))
        )
        step = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        short = F.col("f") < F.col("target")
        low, high = F.when(short, F.col("tilt")).otherwise(F.col("low")), F.when(short, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.when(F.col("df") > 0, F.col("df"))
        error = F.when((F.col("target") <= 0) | F.col("f").isNull(), 0.0).otherwise(F.abs(F.col("f") / F.col("target") - 1))
        step = step.withColumns({"low": low, "high": high, "newton": newton, "error": error})
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        tilt = F.when(F.col("error") <= EXACT, F.col("tilt")).when(F.col("target") >= CAP * F.col("source_size") * (1 - EXACT), F.lit(_HIGH)).when(
            F.coalesce(inside, F.lit(False)), F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        state = materialize(step.withColumn("tilt", tilt).select("source", "source_size", "target", "tilt", "low", "high", "error"))
        if (state.where("target < source_size * 2.9999999").agg(F.max("error")).first()[0] or 0.0) <= EXACT:
            break
    # Sums of doubles differ in their last digits with the order of rows; rounding makes reruns agree.
    return state.select("source", "source_size", "target", F.round("tilt", 9).alias("tilt"))


def _rated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds rate, whole copies and the slot that the shift is compared with."""
    rate = F.least(F.exp(F.col("tilt") * _power(F.col("size"))), F.lit(float(CAP)))
    joined = rows.join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")), "left").drop("plan_source")
    rated = joined.withColumn("rate", F.when(F.col("size") == 0, 1.0).when(rate > CAP - 1e-6, float(CAP)).otherwise(rate))
    even = F.pmod(F.col("draw"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    slot = F.floor((even - (F.col("rate") - F.floor("rate")) + 1) * (_SLOTS // 2)).cast("int")
    return rated.withColumn("whole", F.floor("rate").cast("int")).withColumn("slot", F.when(F.col("rate") >= CAP, _SLOTS).when(F.col("size") == 0, _SLOTS).otherwise(slot))


def _cut(slots: DataFrame) -> DataFrame:
    """source, cut, left: the slot below which all get one more copy, and what is missing to the target then.

    ``slots`` has source, slot, more (the size in it) and need. The nearest cut that takes no more than is needed; none if nothing is needed.
    """
    upto = W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    taken = slots.withColumn("sum", F.sum("more").over(upto))
    best = taken.where(F.col("sum") <= F.col("need")).groupBy("source").agg((F.max("slot") + 1).alias("cut"), F.max("sum").alias("sum"))
    need = slots.groupBy("source").agg(F.max("need").alias("need")).withColumnRenamed("source", "s")
    return need.join(best, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("s"), F.coalesce("cut", F.lit(0)).alias("cut"), (F.col("need") - F.coalesce("sum", F.lit(0))).alias("left"))


def shifts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with cut, the slot below which a document of the source gets one more copy, and a second one for small documents.

    What the first cut leaves is less than the documents of one slot; documents of at most an eighth of it fill it up to ``fine``.
    """
    rated = _rated(rows, plan)
    sure = rated.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need")).withColumnRenamed("source", "n")
    slots = rated.where(F.col("slot") < _SLOTS).groupBy("source", "slot").agg(F.sum("size").alias("more"))
    first = _cut(slots.join(sure, F.col("source").eqNullSafe(F.col("n"))).drop("n"))
    plan = materialize(plan.join(first, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    small = _rated(rows, plan).where((F.col("slot") < _SLOTS) & (F.col("slot") >= F.col("cut")) & (F.col("size") * 8 <= F.col("left")))
    second = _cut(small.groupBy("source", "slot").agg(F.sum("size").alias("more"), F.first("left").alias("need")))
    second = second.select("s", F.col("cut").alias("fine"))
    plan = materialize(plan.join(second, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("pick", F.lit(None).cast("long")))
    # Last, the one document whose further copy comes nearest to what is still missing; it matters where a source has few of them.
    copied = _copies(_rated(rows, plan))
    missing = copied.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing")).withColumnRenamed("source", "s")
    open_ = copied.where((F.col("copies") < CAP) & (F.col("size") > 0)).groupBy("source", "draw").agg(F.sum("size").alias("more"))
    nearest = (
        open_.join(missing, F.col("source").eqNullSafe(F.col("s"))).withColumn("miss", F.abs(F.col("missing") - F.col("more"))).where(F.col("miss") < F.col("missing"))
        .groupBy("s").agg(F.min(F.struct("miss", "draw"))["draw"].alias("pick"))
    )
    return materialize(plan.drop("pick").join(nearest, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))


def planned(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (doc_id, source, size, draw), stored, and the plan with a row per source."""
    rows = materialize(documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size_of(F.col("text")).alias("size"), _draw(F.col("doc_id"), F.col("text")).alias("draw")))
    cells = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    return rows, shifts(rows, tilts(cells, goals))


def _draw(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("long"), text)


def _copies(rated: DataFrame) -> DataFrame:
    small = (F.col("slot") < F.col("fine")) & (F.col("size") * 8 <= F.col("left")) & (F.col("slot") < _SLOTS)
    more = F.coalesce(F.col("slot") < F.col("cut"), F.lit(False)) | F.coalesce(small, F.lit(False))  # no cut: no document to choose from
    picked = F.coalesce(F.col("draw") == F.col("pick"), F.lit(False))
    return rated.withColumn("copies", F.col("whole") + more.cast("int") + picked.cast("int"))


def annotate(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate per document."""
    rows, plan = planned(documents)
    return _copies(_rated(rows, plan)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def mix(documents: DataFrame) -> DataFrame:
    """The rows of the mix, every document as often as its copies, columns unchanged."""
    _, plan = planned(documents)
    given, name = shielded(documents)
    rows = given.withColumns({"source": F.col(name["source"]).cast("string"), "size": size_of(F.col(name["text"])), "draw": _draw(F.col(name["doc_id"]), F.col(name["text"]))})
    copied = _copies(_rated(rows, plan)).withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return copied.select(*(F.col(new).alias(old) for old, new in zip(documents.columns, given.columns)))
