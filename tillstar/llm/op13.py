"""Query op13: the Merkle manifest of all documents with tampered texts, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import merkle
from tillstar.llm.sums import crc32
from tillstar.llm.tables import table


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    now = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, folder, "documents"), now).drop("copied")


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


SQL = rf"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS now
  FROM documents),
placed AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
low(source, lvl, i, n, d) AS (
  SELECT source, 0, i, n, leaf FROM placed
  UNION ALL SELECT source, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY source, lvl, i // 3, n),
subroots AS (
  SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, i, n, d) AS (
  SELECT 0, i, n, d FROM subroots
  UNION ALL SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY lvl, i // 3, n),
low_runs AS (SELECT source, lvl, i // 3 AS run, list(d ORDER BY i) AS ds FROM low WHERE n > 1 GROUP BY source, lvl, i // 3),
high_runs AS (SELECT lvl, i // 3 AS run, list(d ORDER BY i) AS ds FROM high WHERE n > 1 GROUP BY lvl, i // 3),
climb(id, source, lvl, i, cur, proof) AS (
  SELECT id, source, 0, i, now, '' FROM placed
  UNION ALL
  SELECT c.id, c.source, c.lvl + 1, c.i // 3,
    sha256(array_to_string(r.ds[: c.i % 3], '') || c.cur || array_to_string(r.ds[c.i % 3 + 2 :], '')),
    c.proof || array_to_string(r.ds[: c.i % 3], '') || array_to_string(r.ds[c.i % 3 + 2 :], '')
  FROM climb c JOIN low_runs r ON r.source IS NOT DISTINCT FROM c.source AND r.lvl = c.lvl AND r.run = c.i // 3),
ends AS (SELECT id, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM climb GROUP BY id),
further(id, lvl, i, cur, proof) AS (
  SELECT e.id, 0, s.i, e.cur, e.proof FROM ends e JOIN placed p ON p.id = e.id JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT c.id, c.lvl + 1, c.i // 3,
    sha256(array_to_string(r.ds[: c.i % 3], '') || c.cur || array_to_string(r.ds[c.i % 3 + 2 :], '')),
    c.proof || array_to_string(r.ds[: c.i % 3], '') || array_to_string(r.ds[c.i % 3 + 2 :], '')
  FROM further c JOIN high_runs r ON r.lvl = c.lvl AND r.run = c.i // 3),
folded AS (SELECT id, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM further GROUP BY id)
SELECT p.doc_id, p.leaf, s.d AS subroot, t.d AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = t.d AS verified
FROM placed p JOIN folded f ON f.id = p.id JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN high t ON t.n = 1
"""
