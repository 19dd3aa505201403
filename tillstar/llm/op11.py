"""Query op11: all pages written as dictionary-compressed WARC and read back, and its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import warc
from tillstar.llm.tables import table
from tillstar.session import scratch_root


def op11_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, folder, "pages"), files)
    return warc.read(spark, files, payloads=False).drop("target_uri")


SQL = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS f FROM sized)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
FROM firsts
"""
