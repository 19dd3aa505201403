"""Query op1: perplexity of all documents under a model of trusted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import kneser_ney
from tillstar.llm.tables import table


def op1_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
