"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillstar") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    the setting is absent, falls back to a folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tillstar-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def own_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for the stored rows of one run, removed at its end, also after a failure.

    Nothing that is still to be read may depend on rows stored inside.
    """
    folder = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store_rows(df: DataFrame, compression: str = "snappy") -> str:
    """Write ``df`` as Parquet to the scratch folder, the run's own if there is one, and return the path."""
    path = f"{_scratch.get() or scratch_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return path


def materialize(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """:func:`store_rows`, read back.

    Used where a result feeds several jobs that must see the very same rows: the
    files survive the loss of an executor, and later readers prune columns.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store_rows(df, compression))
