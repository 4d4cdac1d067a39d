"""Preference pairs from ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.preferences import preference_pairs
from cyclemart.llm.tables import query, read

SQL = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
answers AS (
  SELECT conv_id, max(turn) AS last, max_by(text, turn) AS answer FROM turns WHERE role = 'assistant' GROUP BY conv_id
), chosen AS (
  SELECT conv_id AS pair_id, turn, role, text FROM turns JOIN answers USING (conv_id) WHERE turn <= last
), rejected AS (
  SELECT conv_id AS pair_id, turn, role, text FROM turns JOIN answers USING (conv_id) WHERE turn < last
  UNION ALL
  SELECT a.conv_id, a.last, 'assistant', b.answer FROM answers a JOIN answers b ON b.conv_id = xor(a.conv_id, 1)
), merged AS (
  SELECT pair_id, turn, role, text, bit_or(side) AS side
  FROM (SELECT *, 1 AS side FROM chosen UNION ALL SELECT *, 2 FROM rejected) GROUP BY ALL
), placed AS (
  SELECT *, min(CASE WHEN side <> 3 THEN turn END) OVER (PARTITION BY pair_id) AS start,
    '<|' || role || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM merged
), sided AS (
  SELECT *, 0 AS part FROM placed WHERE start IS NULL OR turn < start
  UNION ALL SELECT *, 1 FROM placed WHERE turn >= start AND side & 1 = 1
  UNION ALL SELECT *, 2 FROM placed WHERE turn >= start AND side & 2 = 2
), measured AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY pair_id, part ORDER BY turn, role, text) AS stop FROM sided
)
SELECT pair_id AS conv_id,
  coalesce(string_agg(head || body, '' ORDER BY turn, role, text) FILTER (part = 0), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY turn, role, text) FILTER (part = 1), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY turn, role, text) FILTER (part = 2), '') AS rejected,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY stop) FILTER (part = 1 AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY stop) FILTER (part = 2 AND role = 'assistant'), '') AS rejected_mask,
  CAST(count(*) FILTER (part = 0) AS INTEGER) AS prompt_turns
FROM measured GROUP BY pair_id
"""


def neighbour_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation up to its last answer, and the same with the last answer of its neighbour (ids that differ
    in the lowest bit). Conversations without an answer have no pair; without a neighbour, nothing is rejected in
    place of the answer."""
    # Ties of the last turn: the largest text.
    answers = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last"))
    last = turns.filter("role = 'assistant'").join(answers, "conv_id").filter(F.col("turn") == F.col("last"))
    answers = last.groupBy("conv_id", "last").agg(F.max("text").alias("answer"))
    named = turns.join(answers.drop("answer"), "conv_id").withColumnRenamed("conv_id", "pair_id")
    chosen = named.filter("turn <= last").select("pair_id", "turn", "role", "text")
    other = answers.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("answer").alias("text"))
    swapped = answers.withColumnRenamed("conv_id", "pair_id").join(other, "pair_id").select(
        "pair_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"), "text"
    )
    rejected = named.filter("turn < last").select("pair_id", "turn", "role", "text").unionByName(swapped)
    return chosen, rejected


@query("op2_chat_formatting", SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = neighbour_answers(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    pairs = preference_pairs(chosen, rejected)

    def mask(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")

    return pairs.select(
        F.col("pair_id").alias("conv_id"), "prompt", "chosen", "rejected", mask("chosen_spans").alias("chosen_mask"),
        mask("rejected_spans").alias("rejected_mask"), "prompt_turns",
    )
