"""Query op3: near-duplicate embeddings by pivot permutations, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import pivots
from tillstar.llm.tables import table


def op3_pivot_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, folder, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(l.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN links k ON k.a = e.vec_id
"""
