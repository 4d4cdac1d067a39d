"""Quality rules over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.quality_rules import STOP_WORDS, quality_rules
from cyclemart.llm.tables import query, read

_STOPS = ", ".join(f"'{w}'" for w in sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())}))

SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 4] AS five FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM repeated) GROUP BY doc_id
), base AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS stops,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS twins,
    len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:;\x{{2026}}\x{{3002}}"'')\x{{bb}}\x{{201d}}][ \t\r\x0b\x0c]*$'))) AS ended
  FROM texts LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND word_chars / n_words BETWEEN 2.5 AND 12
    AND n_symbols / n_words <= 0.1
    AND stops / n_words >= 0.02
    AND twins / n_words <= 0.2
    AND n_dup_lines / n_lines <= 0.4
    AND ended / n_lines >= 0.3 AS kept
FROM base
"""


@query("op1_quality_rules", SQL)
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"),
    )
