"""Order-line files that keep arriving, loaded batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstar.operators import clean as cleaning
from tillstar.operators import features
from tillstar.plans.load import load_all
from tillstar.session import materialize, own_scratch
from tillstar.sources.files import read_raw
from tillstar.sources.store import Store


def arrivals(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Paths of new files of the landing folder as a stream; their content is not read here."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (
        spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")
    )


def load_arrivals(spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
                  files_per_batch: int = 1000) -> StreamingQuery:
    """Start loading whatever has arrived; the query ends when it is caught up.

    A batch is at most ``files_per_batch`` paths, read like any other files: by their own encoding, quotes and
    column names, and loaded in one commit. A batch that is delivered again after a failure is known by its number and skipped. Under a new
    checkpoint facts leave out loaded (order, product) pairs, and dimensions what they already hold.
    """
    name = f"stream {checkpoint}"

    def load(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, warehouse)
        store.create_tables()
        if store.load(name, batch_id).repeated:
            return
        paths = [r.path for r in batch.collect()]
        if not paths:
            return
        with own_scratch(batch.sparkSession):
            rows = read_raw(batch.sparkSession, paths)
            silver = materialize(features.transform(materialize(cleaning.clean(rows))))
            if not silver.isEmpty():
                load_all(store, silver, idempotent=True, name=name, number=batch_id)

    return (
        arrivals(spark, landing, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
