"""Query op6: all documents mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import mixture
from tillstar.llm.tables import table


def op6_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.annotate(table(spark, folder, "documents"))
