"""Query op10: near-duplicate documents by MinHash, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import minhash
from tillstar.llm.tables import table


def op10_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s
  FROM words),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, n AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(l.b, d.doc_id)) = d.doc_id AS kept
FROM sized d LEFT JOIN least l ON l.a = d.doc_id
"""
