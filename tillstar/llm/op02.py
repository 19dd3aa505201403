"""Query op2: unigram token counts of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import trie
from tillstar.llm.tables import table


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return trie.token_counts(table(spark, folder, "documents"))
