"""Stored tables: Parquet parts that become visible by commits.

Every write makes a new part folder, which nobody reads until a commit names it. A commit is a small JSON file with the parts of all tables: their
folders, rows, years, largest key and the load that wrote them. It is put in place by one rename that fails if another load was faster, so the dimensions and
the facts of a load become visible together or not at all, no plan overwrites what it reads, and a failed load leaves only
folders that :meth:`Store.remove_unnamed` deletes. A load with a name is known by it when it is repeated.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.schemas import FACTS, STORED, TABLES

log = logging.getLogger(__name__)
PARTITIONS = {FACTS: ("order_year",)}
#: The surrogate key of each table, whose largest value a part records.
KEYS = {"dim_date": "date_key", "dim_category": "category_key", "dim_region": "region_key", "dim_customer": "customer_key",
        "dim_product": "product_key", FACTS: "sales_key"}
#: Into how many buckets a table is cut that is changed in place.
BUCKETS = {"dim_customer": 16}
_COMMITS = "_commits"


class Conflict(Exception):
    """Another load was committed first; this one has to begin again."""


@dataclass(frozen=True)
class Part:
    """A folder of rows. ``years`` and ``bucket`` are None where the table has none."""

    path: str
    rows: int
    load: str
    version: int
    largest: int | None = None
    years: tuple[int, ...] | None = None
    bucket: int | None = None


@dataclass(frozen=True)
class Commit:
    """What is visible: the parts of each table, and the last number of every named load."""

    number: int = 0
    tables: dict[str, tuple[Part, ...]] = field(default_factory=dict)
    versions: dict[str, int] = field(default_factory=dict)
    loads: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        parts = {t: [{k: v for k, v in p.__dict__.items() if v is not None} for p in rows] for t, rows in self.tables.items()}
        return json.dumps({"number": self.number, "tables": parts, "versions": self.versions, "loads": self.loads})

    @classmethod
    def of(cls, text: str) -> Commit:
        said = json.loads(text)
        parts = {t: tuple(Part(**{**p, "years": tuple(p["years"])} if "years" in p else p) for p in rows) for t, rows in said["tables"].items()}
        return cls(said["number"], parts, said["versions"], said["loads"])


class Store:
    """Tables under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- the commits -----------------------------------------------------------

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []

    def commit_numbers(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in self._children(f"{self.root}/{_COMMITS}") if name.endswith(".json") and name[0].isdigit())

    def commit(self, number: int | None = None) -> Commit:
        """The newest commit, or the one with ``number``."""
        numbers = self.commit_numbers()
        if not numbers:
            return Commit()
        fs, where = self._fs(f"{self.root}/{_COMMITS}/{number or numbers[-1]:012d}.json")
        source = fs.open(where)
        try:
            return Commit.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def put(self, commit: Commit) -> None:
        """Make ``commit`` the newest one, or raise :class:`Conflict`."""
        jvm = self.spark._jvm
        fs, fresh = self._fs(f"{self.root}/{_COMMITS}/new-{uuid.uuid4().hex}")
        target = self._fs(f"{self.root}/{_COMMITS}/{commit.number:012d}.json")[1]
        out = fs.create(fresh, False)
        try:
            out.write(bytearray(commit.text().encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(fs.makeQualified(fresh), fs.makeQualified(target), plain)
        except Py4JJavaError as error:
            fs.delete(fresh, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise Conflict(f"commit {commit.number} was taken") from error
            raise

    def load(self, name: str | None = None, number: int = 0) -> Load:
        """A load on top of the newest commit."""
        return Load(self, self.commit(), name, number)

    # --- reading ---------------------------------------------------------------

    def frame(self, table: str, parts: Sequence[Part], schema=None) -> DataFrame:
        schema = schema or STORED.get(table)
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        if schema is None:
            return reader.parquet(*[f"{self.root}/{p.path}" for p in parts]).drop("part", "bucket")
        return reader.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in parts]).select(*schema.fieldNames())

    def versions(self, table: str) -> list[int]:
        """Versions in the commits that are kept, oldest first."""
        found = {c.versions[table] for c in map(self.commit, self.commit_numbers()) if table in c.versions}
        return sorted(found)

    def exists(self, table: str) -> bool:
        return table in self.commit().tables

    def read(self, table: str) -> DataFrame:
        """All committed rows; a known table without any is empty."""
        return self.frame(table, self.commit().tables.get(table, ()))

    def tables(self) -> dict[str, DataFrame]:
        """The known tables as one commit has them."""
        now = self.commit()
        return {name: self.frame(name, now.tables.get(name, ())) for name in TABLES}

    def parts(self) -> DataFrame:
        """The newest commit as rows: table_name, load, version, rows, largest, first_year, last_year, bucket, path."""
        rows = [(t, p.load, p.version, p.rows, p.largest, min(p.years) if p.years else None, max(p.years) if p.years else None, p.bucket, p.path)
                for t, parts in self.commit().tables.items() for p in parts]
        return self.spark.createDataFrame(
            rows, "table_name string, load string, version int, rows long, largest long, first_year int, last_year int, bucket int, path string")

    # --- single writes ---------------------------------------------------------

    def _alone(self, action: Callable[[Load], object]) -> None:
        load = self.load()
        action(load)
        load.commit()

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next version and return it as stored."""
        self._alone(lambda load: load.replace(table, df))
        return self.read(table)

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows to the newest version."""
        self._alone(lambda load: load.append(table, df))
        return self.read(table)

    def create_tables(self) -> None:
        """Empty tables for those not there yet, in one commit."""
        now = self.commit()
        missing = [t for t in STORED if t not in now.tables]
        if missing:
            self.put(Commit(now.number + 1, {**now.tables, **{t: () for t in missing}}, {**now.versions, **{t: 1 for t in missing}}, now.loads))

    def drop_tables(self) -> None:
        """Remove the known tables under this folder and nothing else."""
        now = self.commit()
        if not now.number:
            return
        self.put(Commit(now.number + 1, {t: p for t, p in now.tables.items() if t not in STORED},
                        {t: v for t, v in now.versions.items() if t not in STORED}, {}))
        for table in STORED:
            fs, where = self._fs(f"{self.root}/{table}")
            if fs.exists(where):
                fs.delete(where, True)

    def remove_unnamed(self, keep: int = 1) -> list[str]:
        """Delete the folders that none of the last ``keep`` commits names, and the commits before them; returns the folders.

        Not to be called while a load or a reader of an older commit is at work.
        """
        numbers = self.commit_numbers()
        named = {p.path for n in numbers[-keep:] for parts in self.commit(n).tables.values() for p in parts}
        kept = {path.split("/part=")[0] + "/part=" + path.split("/part=")[1].split("/")[0] for path in named}
        gone = []
        for table in self._children(self.root):
            for child in self._children(f"{self.root}/{table}"):
                path = f"{table}/{child}"
                # A part of buckets loses the buckets that were written again.
                inner = [f"{path}/{c}" for c in self._children(f"{self.root}/{path}") if c.startswith("bucket=")] if path in kept else []
                gone += [path] if child.startswith("part=") and path not in kept else [p for p in inner if path not in named and p not in named]
        for path in [*gone, *[f"{_COMMITS}/{n:012d}.json" for n in numbers[:-keep]]]:
            fs, where = self._fs(f"{self.root}/{path}")
            fs.delete(where, True)
        return gone

    def register_views(self, names: tuple[str, ...] = tuple(TABLES)) -> None:
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    def health(self) -> DataFrame:
        """Rows and stored bytes of every table, -1 rows where it cannot be read."""
        rows = None
        for name in TABLES:
            one = self._one_table(name)
            rows = one if rows is None else rows.unionByName(one)
        return rows

    def _one_table(self, name: str) -> DataFrame:
        now = self.commit()
        if name not in now.tables:
            return self.spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit(-1).cast("bigint").alias("row_count"), F.lit(0).cast("bigint").alias("size_bytes"))
        size = 0
        for part in now.tables[name]:
            fs, where = self._fs(f"{self.root}/{part.path}")
            size += fs.getContentSummary(where).getLength()
        return self.frame(name, now.tables[name]).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(size).cast("bigint").alias("size_bytes"))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Load:
    """Writes that become visible together at :meth:`commit`; :meth:`read` sees them before."""

    def __init__(self, store: Store, base: Commit, name: str | None, number: int) -> None:
        self.store, self.base, self.number = store, base, number
        self.name = name or f"load-{uuid.uuid4().hex}"
        self.named = name is not None
        self.changed: dict[str, tuple[Part, ...]] = {}
        self.versions: dict[str, int] = {}

    @property
    def repeated(self) -> bool:
        """Whether this load, or a later one of its name, has been committed."""
        return self.named and self.base.loads.get(self.name, -1) >= self.number

    def parts(self, table: str) -> tuple[Part, ...]:
        return self.changed.get(table, self.base.tables.get(table, ()))

    def read(self, table: str, years: Sequence[int] | None = None) -> DataFrame:
        """Rows as this load sees them; with ``years`` only those, from the parts that have any of them."""
        if years is None:
            return self.store.frame(table, self.parts(table))
        return self.store.frame(table, self._of_years(table, years)).filter(F.col("order_year").isin(*years))

    def _of_years(self, table: str, years: Sequence[int]) -> list[Part]:
        return [p for p in self.parts(table) if p.years is None or set(p.years) & set(years)]

    def has(self, table: str, years: Sequence[int]) -> bool:
        """Whether any part may hold rows of ``years``."""
        return bool(self._of_years(table, years))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def largest(self, table: str) -> int:
        """The largest surrogate key, from what the parts say."""
        return max((p.largest or 0 for p in self.parts(table)), default=0)

    def _version(self, table: str) -> int:
        return self.versions.get(table, self.base.versions.get(table, 1))

    def write(self, table: str, df: DataFrame, by: Sequence[str] = (), gather: bool = True) -> tuple[str, DataFrame]:
        """Write a part folder; returns its path and the rows as stored. Without ``gather`` each task of ``df`` writes its own files."""
        path = f"{table}/part={uuid.uuid4().hex}"
        # Few files: rows of a partition meet first, and Spark cuts or joins what gets too large or too small.
        rows = df.hint("rebalance", *by) if by and gather else df
        rows.write.option("compression", "zstd").partitionBy(*by).parquet(f"{self.store.root}/{path}")
        return path, self.store.spark.read.schema(df.schema).option("basePath", f"{self.store.root}/{path}").parquet(f"{self.store.root}/{path}")

    def _part(self, table: str, df: DataFrame, gather: bool = True) -> Part | None:
        """The new part, None if it has no rows. Only the key column and the folders' names are read again."""
        by = PARTITIONS.get(table, ())
        path, rows = self.write(table, df, by, gather)
        key = F.max(KEYS[table]) if table in KEYS else F.lit(None)
        years = F.collect_set("order_year") if by else F.array()
        said = rows.agg(F.count(F.lit(1)).alias("rows"), key.cast("bigint").alias("largest"), years.alias("years")).first()
        return Part(path, said.rows, self.name, self._version(table), said.largest, tuple(sorted(said.years)) if by else None) if said.rows else None

    def append(self, table: str, df: DataFrame, gather: bool = True) -> int:
        """Add rows; returns how many."""
        part = self._part(table, df, gather)
        self.changed[table] = (*self.parts(table), part) if part else self.parts(table)
        return part.rows if part else 0

    def replace(self, table: str, df: DataFrame) -> int:
        """Let ``df`` be the table's next version."""
        if table in self.base.tables and table not in self.versions:
            self.versions[table] = self._version(table) + 1
        self.versions.setdefault(table, 1)
        part = self._part(table, df)
        self.changed[table] = (part,) if part else (Part(self.write(table, df)[0], 0, self.name, self._version(table)),) if table not in STORED else ()
        return part.rows if part else 0

    def buckets(self, table: str, keys: DataFrame, key: str) -> list[int] | None:
        """The buckets that ``keys`` fall into; None for all where the table is not cut yet."""
        if any(p.bucket is None for p in self.parts(table)):
            return None
        return sorted(r[0] for r in keys.select(bucket_of(F.col(key), BUCKETS[table])).distinct().collect())

    def read_buckets(self, table: str, buckets: list[int] | None, schema=None) -> DataFrame:
        return self.store.frame(table, [p for p in self.parts(table) if buckets is None or p.bucket in buckets], schema)

    def swap_buckets(self, table: str, buckets: list[int] | None, df: DataFrame, bucket: Column) -> None:
        """Put ``df``, all rows of ``buckets``, in their place; the other buckets' files stay as they are."""
        path, stored = self.write(table, df.withColumn("bucket", bucket.cast("int")), ("bucket",))
        largest = F.max(KEYS[table]) if table in KEYS else F.lit(None).cast("bigint")
        said = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), largest.alias("largest")).collect()
        fresh = [Part(f"{path}/bucket={r.bucket}", r.rows, self.name, self._version(table), r.largest, bucket=r.bucket) for r in sorted(said)]
        rest = [] if buckets is None else [p for p in self.parts(table) if p.bucket not in buckets]
        self.changed[table] = (*rest, *fresh)

    def expire(self, table: str, before: int) -> int:
        """Leave out the buckets under ``before``; returns how many. Their files go with :meth:`Store.remove_unnamed`."""
        kept = tuple(p for p in self.parts(table) if p.bucket is None or p.bucket >= before)
        gone = len(self.parts(table)) - len(kept)
        if gone:
            self.changed[table] = kept
        return gone

    def commit(self) -> Commit:
        """Make everything visible; a :class:`Conflict` leaves it invisible."""
        base = self.base
        loads = {**base.loads, **({self.name: self.number} if self.named else {})}
        versions = {**base.versions, **{t: self._version(t) for t in self.changed}}
        commit = Commit(base.number + 1, {**base.tables, **self.changed}, versions, loads)
        self.store.put(commit)
        self.base, self.changed, self.versions = commit, {}, {}
        return commit


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def changed_partitions(facts: DataFrame, seen: DataFrame | None, today, refresh_months: int = 3, keep_years: int = 5) -> DataFrame:
    """Year-month partitions to refresh: complete, recent, and newer than last ``seen``.

    ``seen`` holds ``order_year, order_month, last_change`` of the previous refresh.
    """
    month = F.floor(F.col("order_date_key") / 100).cast("int") % 100
    parts = facts.groupBy("order_year", month.cast("int").alias("order_month")).agg(F.max("updated_at").alias("last_change"))
    age = (F.year(F.lit(today)) * 12 + F.month(F.lit(today))) - (F.col("order_year") * 12 + F.col("order_month"))
    due = parts.withColumn("age", age).filter((F.col("age") >= 1) & (F.col("age") <= refresh_months)
                                              & (F.col("order_year") > F.year(F.lit(today)) - keep_years))
    if seen is None:
        return due.drop("age")
    before = seen.withColumnRenamed("last_change", "_seen_change")
    return (
        due.join(before, ["order_year", "order_month"], "left")
        .filter(F.col("_seen_change").isNull() | (F.col("last_change") > F.col("_seen_change")))
        .select("order_year", "order_month", "last_change")
    )


def overwrite_partitions(df: DataFrame, path: str, partition_columns: tuple[str, ...]) -> None:
    """Replace only the partitions that occur in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_columns).parquet(path))
