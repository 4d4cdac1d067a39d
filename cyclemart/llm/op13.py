"""``documents`` ranked for each item of ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.ranked_search import ranked
from cyclemart.llm.tables import query, read

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce({_WORDS}, []) AS words FROM documents
), corpus AS (
  SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM texts WHERE len(words) > 0
), postings AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, len(words) AS n, unnest(words) AS term FROM texts)
  GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
), impacts AS (
  SELECT place, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS impact
  FROM postings JOIN weights USING (term), corpus
), asked AS (
  SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark
), scores AS (
  SELECT a.item_id, i.place, i.doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked a JOIN impacts i ON a.term = i.term GROUP BY ALL HAVING sum(impact) > 0
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scores
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""


@query("op13_ranked_search", SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return ranked(docs.select("doc_id", "text"), items.select("item_id", "text"), k=50)
