"""Query op12: spelling variants in all documents, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import spelling
from tillstar.llm.sums import crc32
from tillstar.llm.tables import table


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
per AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY id, run),
hashed AS (SELECT run, n, {crc32("id || ':' || run")} AS h FROM per),
results AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 2 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 2 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
walk(word, here, form) AS (
  SELECT word, word, form FROM formed UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN formed f ON f.word = k.form)
SELECT f.word, f.form, k.here AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk k ON k.word = f.word AND k.form IS NULL
"""
