"""Collects the registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.plans.star import SourceStar, Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which is what the SQL side computes."""
    return df.select([
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, folder: comparable(build(spark, folder))
    if sql is not None:
        ORACLES[name] = sql


def star_query(name: str, build: Callable[[Star], DataFrame], sql: str | None = None) -> None:
    query(name, lambda spark, folder: build(SourceStar(spark, folder)), sql)
