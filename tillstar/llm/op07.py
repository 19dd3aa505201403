"""Query op7: all documents written as coded token ids and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import ans
from tillstar.llm.tables import table
from tillstar.session import scratch_root


def op7_ans_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    ans.write(table(spark, folder, "documents"), files)
    return ans.read(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
