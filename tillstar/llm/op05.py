"""Query op5: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import privacy
from tillstar.llm.tables import table


def op5_pii_sanitisation(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.annotate(table(spark, folder, "documents"))
