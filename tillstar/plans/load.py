"""Loading prepared order lines into the star, and the whole run."""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import clean as cleaning
from tillstar.operators import dimensions, facts, features, quality, scd2
from tillstar.operators.dedup import flag_exact_duplicates
from tillstar.plans.summaries import refresh_changed
from tillstar.schemas import CUSTOMER_HISTORY, FACTS, REJECTS, STAGING_CLEAN, STAGING_RAW, STORED, TABLES, staged_name
from tillstar.session import materialize, own_scratch
from tillstar.sources import files
from tillstar.sources.store import BUCKETS, Load, Store, bucket_of

log = logging.getLogger(__name__)
#: Facts that a task writes, a file per year.
FACT_ROWS = 500_000


def load_dimensions(load: Load, batch: DataFrame, daily: bool = False) -> dict[str, int]:
    """Extend all dimensions; returns the new rows per table."""
    added = {}
    for name, build in (
        ("dim_date", lambda: dimensions.new_dates(load.read("dim_date"), batch)),
        ("dim_category", lambda: dimensions.new_categories(load.read("dim_category"), batch)),
        ("dim_region", lambda: dimensions.new_regions(load.read("dim_region"), batch)),
        ("dim_product", lambda: dimensions.new_products(load.read("dim_product"), batch, load.read("dim_category"))),
    ):
        added[name] = load.append(name, build())
    added["dim_customer"] = load_customers(load, batch, daily)
    return added


def load_customers(load: Load, batch: DataFrame, daily: bool = False) -> int:
    """Splice the customers of ``batch`` into their history; only the buckets they fall into are read and written."""
    table, key = "dim_customer", "customer_id"
    ids = batch.where("`Customer ID` IS NOT NULL").select(F.col("Customer ID").alias(key))
    buckets = load.buckets(table, ids, key)
    existing = load.read_buckets(table, buckets, CUSTOMER_HISTORY)
    versions, added = scd2.splice_customers(existing, batch, load.largest(table), daily)
    if buckets is None or buckets:
        load.swap_buckets(table, buckets, versions, bucket_of(F.col(key), BUCKETS[table]))
    return added


def load_facts(load: Load, batch: DataFrame, resolve: str = "current", idempotent: bool = False) -> tuple[int, int]:
    """Append the resolved lines and keep the rejected ones; returns how many of each."""
    resolved = materialize(facts.kept_of(facts.resolve_keys(batch, load.tables(), resolve, thin=True)), "zstd")
    rows = facts.fact_rows(resolved)
    years = facts.years_of(rows) if idempotent else []
    repeatable = bool(years) and load.has(FACTS, years)
    if repeatable:
        rows = facts.without_loaded(rows, load.read(FACTS, years))
    else:  # read from files only, so the rows of a year need no shuffle to meet in few files
        rows = rows.coalesce(resolved.count() // FACT_ROWS + 1)
    loaded = load.append(FACTS, facts.with_sales_keys(rows, load.largest(FACTS)), gather=repeatable)
    return loaded, load.append(REJECTS, facts.reject_rows(resolved, load.name))


def load_all(store: Store, batch: DataFrame, resolve: str = "current", idempotent: bool = False, name: str | None = None, number: int = 0,
             daily: bool = False) -> dict[str, int]:
    """Dimensions and facts in one commit; the number of new rows per table.

    Readers see the state before until all is written. A load with a ``name`` that was committed with this ``number`` or a later one adds
    nothing and reads nothing.
    """
    load = store.load(name, number)
    if load.repeated:
        return {**dict.fromkeys(TABLES, 0), "rejected": 0}
    added = load_dimensions(load, batch, daily)
    added[FACTS], added["rejected"] = load_facts(load, batch, resolve, idempotent)
    load.commit()
    return added


def stage(store: Store, raw: DataFrame, silver: DataFrame) -> dict[str, int]:
    """Let the lines of a run, as read and as loaded, be the content of the two staging tables; the rows of each."""
    load, rows = store.load(), {}
    for table, lines in ((STAGING_RAW, raw), (STAGING_CLEAN, silver)):
        own = {staged_name(c): F.col(f"`{c}`") for c in lines.columns}
        rows[table] = load.replace(table, lines.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STORED[table].fields]))
    load.commit()
    return rows


@dataclass
class RunResult:
    """What one run did."""

    run_id: str
    status: str = "SUCCESS"
    start_time: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))
    end_time: dt.datetime | None = None
    rows_extracted: int = 0
    rows_cleaned: int = 0
    rows_transformed: int = 0
    rows_loaded: int = 0
    rows_rejected: int = 0
    rows_malformed: int = 0
    raw_quality_score: float = 100.0
    transformed_quality_score: float = 100.0
    stage_seconds: dict[str, float] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        """0 for success, 2 for failed quality checks, 1 for an error."""
        return {"SUCCESS": 0, "QUALITY_FAILURE": 2}.get(self.status, 1)

    def as_row(self, spark: SparkSession) -> DataFrame:
        names = [n for n in self.__dataclass_fields__]
        schema = ("run_id string, status string, start_time timestamp, end_time timestamp, rows_extracted bigint, "
                  "rows_cleaned bigint, rows_transformed bigint, rows_loaded bigint, rows_rejected bigint, rows_malformed bigint, "
                  "raw_quality_score double, transformed_quality_score double, stage_seconds map<string,double>, errors array<string>")
        return spark.createDataFrame([tuple(getattr(self, n) for n in names)], schema)


class QualityFailure(Exception):
    """Critical checks failed and the run was told to stop."""


class _Run:
    def __init__(self, spark: SparkSession, path: str, work: str, on_critical: str, resolve: str, idempotent: bool, null_words: tuple[str, ...],
                 name: str | None, staging: bool) -> None:
        self.spark, self.path, self.work = spark, path, work.rstrip("/")
        self.on_critical, self.resolve, self.idempotent, self.null_words = on_critical, resolve, idempotent, null_words
        self.name, self.staging, self.result = name, staging, RunResult(run_id=uuid.uuid4().hex)

    def timed(self, stage: str, action):
        start = time.monotonic()
        try:
            return action()
        finally:
            self.result.stage_seconds[stage] = time.monotonic() - start

    def check(self, df: DataFrame, stage: str) -> float:
        results = materialize(quality.validate(df))
        report = quality.quality_report(results, stage)
        files.write_report(report, f"{self.work}/reports", self.result.run_id, stage)
        row = report.select("failed", "quality_score").first()
        if row.failed:
            self.result.errors.append(f"{stage} validation has {row.failed} critical failures")
            self.result.status = "QUALITY_FAILURE"
            if self.on_critical == "stop":
                raise QualityFailure(stage)
        return row.quality_score

    def extract(self) -> DataFrame:
        # The files are read once, whatever becomes of their rows.
        marked = materialize(files.read_marked(self.spark, self.path, null_words=self.null_words), "zstd")
        malformed = f"{self.work}/malformed/run_id={self.result.run_id}"
        files.malformed(marked).write.mode("overwrite").parquet(malformed)
        self.result.rows_malformed = self.spark.read.schema("record string").parquet(malformed).count()
        raw = flag_exact_duplicates(files.well_formed(marked), stored=True)
        self.result.rows_extracted = raw.count()
        if not self.result.rows_extracted:
            raise files.SourceError(f"no order lines in {self.path}")
        return raw

    def clean(self, raw: DataFrame) -> DataFrame:
        cleaned = materialize(cleaning.clean(raw), "zstd")
        self.result.rows_cleaned = cleaned.count()
        self.result.rows_rejected = self.result.rows_extracted - self.result.rows_cleaned
        files.write_audit(cleaned, f"{self.work}/clean", self.result.run_id)
        return cleaned

    def transform(self, cleaned: DataFrame) -> DataFrame:
        silver = materialize(features.transform(cleaned), "zstd")
        self.result.rows_transformed = silver.count()
        files.write_audit(silver, f"{self.work}/processed", self.result.run_id)
        return silver

    def load(self, raw: DataFrame, silver: DataFrame) -> None:
        store = Store(self.spark, f"{self.work}/warehouse")
        store.create_tables()
        if self.staging:
            stage(store, raw, silver)
        self.result.rows_loaded = load_all(store, silver, self.resolve, self.idempotent, self.name)[FACTS]
        tables = store.tables()
        checks = materialize(
            quality.referential_integrity(silver, tables["dim_customer"], tables["dim_product"], tables["dim_region"])
            .unionByName(quality.inverted_versions(tables["dim_customer"])).unionByName(quality.shared_category_codes(tables["dim_category"])))
        files.write_report(quality.quality_report(checks, "post_load"), f"{self.work}/reports", self.result.run_id, "post_load")

    def stages(self, mode: str) -> None:
        result = self.result
        raw = self.timed("extract", self.extract)
        result.raw_quality_score = self.timed("raw_validation", lambda: self.check(raw, "raw"))
        if mode == "validate":
            return
        cleaned = self.timed("clean", lambda: self.clean(raw))
        silver = self.timed("transform", lambda: self.transform(cleaned))
        result.transformed_quality_score = self.timed("transformed_validation", lambda: self.check(silver, "transformed"))
        if mode == "dry-run":
            return
        self.timed("load", lambda: self.load(raw, silver))


def run(spark: SparkSession, path: str, work: str, mode: str = "full", on_critical: str = "flag",
        resolve: str = "current", idempotent: bool = False, null_words: tuple[str, ...] = files.NULL_WORDS, name: str | None = None,
        staging: bool = False) -> RunResult:
    """Read, check, clean, transform, check again and load.

    ``mode`` may stop after the first checks (``validate``) or before loading
    (``dry-run``). Failed critical checks only mark the run unless ``on_critical``
    is ``stop``. Each stage is stored, so later stages never repeat earlier ones. A run with the ``name`` of one that was loaded loads nothing.
    ``staging`` also keeps its lines as tables (:func:`stage`).
    """
    if mode not in ("full", "validate", "dry-run"):
        raise ValueError(f"unknown mode {mode!r}")
    job = _Run(spark, path, work, on_critical, resolve, idempotent, null_words, name, staging)
    try:
        with own_scratch(spark):
            job.stages(mode)
    except QualityFailure:
        pass
    except Exception as error:
        log.exception("run %s failed", job.result.run_id)
        job.result.status = "FAILED"
        job.result.errors.append(str(error))
    job.result.end_time = dt.datetime.now(dt.timezone.utc)
    return job.result


def run_daily(spark: SparkSession, path: str, work: str, **options) -> RunResult:
    """A run, then the summaries; they are left alone if the run failed."""
    result = run(spark, path, work, **options)
    if result.status != "FAILED":
        store = Store(spark, f"{work.rstrip('/')}/warehouse")
        with own_scratch(spark):
            refresh_changed(store)
    return result
