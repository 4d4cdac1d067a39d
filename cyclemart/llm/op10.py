"""Near-duplicate classes of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.near_duplicates import NearDuplicates, near_duplicate_components
from cyclemart.llm.tables import query, read

SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS shingles
  FROM words
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n - count(*) AS total, count(*) AS common
  FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id < y.doc_id AND x.n * 100 >= 80 * y.n AND y.n * 100 >= 80 * x.n
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 80 * total
  UNION ALL SELECT b, a FROM shared WHERE 100 * common >= 80 * total
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest USING (doc_id)
"""


@query("op10_near_duplicates", SQL)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    classes = near_duplicate_components(docs, NearDuplicates(shingle=2))
    return classes.select("doc_id", "n_shingles", "component_id", "kept")
