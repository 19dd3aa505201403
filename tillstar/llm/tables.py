"""How the operators' queries read the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns given_0, given_1, ... and where each old name went, so that no name meets an operator's own."""
    new = [f"given_{i}" for i in range(len(df.columns))]
    return df.toDF(*new), dict(zip(df.columns, new))
