"""Query op8: all documents packed into sequences of at most 2048 tokens."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import packing, tokens
from tillstar.llm.tables import table

COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def digest(packed: DataFrame) -> DataFrame:
    """Checksums in place of the ids."""
    kind = tokens.kind_of(tokens.shared_tokenizer(packed.sparkSession).value)

    def run(batches):
        for batch in batches:
            sums = pa.array([zlib.crc32(tokens.wide(x.as_py(), kind)) for x in batch.column("ids")], pa.int64())
            yield pa.RecordBatch.from_arrays([sums if c == "ids_crc32" else batch.column(c) for c in COLUMNS], list(COLUMNS))

    return packed.mapInArrow(run, SCHEMA)


def op8_configuration_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digest(packing.pack(table(spark, folder, "documents")))
