"""Query op9: quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import quality
from tillstar.llm.tables import table


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.annotate(documents, quality.fit(documents, table(spark, folder, "labels")))
