"""The prefix trie of rebuilt ``conversations``: each starts with the first turns of its hundred's first conversation."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.prefix_trie import TURNS, conversation_turns, member_lists, prefix_nodes
from cyclemart.llm.tables import query, read, written

NO_MEMBERS = hashlib.sha256(b"").hexdigest()

#: Bit by bit: the list has each byte of the decimal number and seven zeros, a step for each bit.
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten([[ord(c), 0, 0, 0, 0, 0, 0, 0] for c in string_split(CAST(conv_id AS VARCHAR), '')])),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""

SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn ASC NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, {_CRC} % 6 AS h FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
), beginnings AS (
  SELECT conv_id, turns[1:d] AS path, d, d = len(turns) AS whole FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256
  FROM beginnings GROUP BY path, d
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.d = p.d + 1 AND n.path[1:n.d - 1] = p.path
), children AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), scored AS (
  SELECT nodes.path, nodes.d, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf, CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.path[-1].t) END AS saved
  FROM nodes LEFT JOIN children ON nodes.d = children.d AND nodes.path = children.path
), sums AS (
  SELECT path[1:up] AS path, up AS d, sum(leaf) AS n_leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM scored) GROUP BY ALL
)
SELECT conv_id, CAST(l.d AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM linked l JOIN sums s ON l.d = s.d AND l.path = s.path LEFT JOIN children c ON l.d = c.d AND l.path = c.path
"""


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of the hundred's first conversation, then the own ones after the first h."""
    own = written(conversation_turns(turns), "conversation-turns")
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6).cast("int")
    heads = own.filter(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, 5).alias("start"))
    joined = own.withColumn("h", h).join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("head"), "left")
    start = F.slice(F.coalesce("start", F.array().cast(TURNS)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(start, rest).alias("turns"))


@query("op12_prefix_trie", SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = written(rebuilt(read(spark, sf_dir, "conversations")), "rebuilt")
    ends = member_lists(sequences)
    return prefix_nodes(sequences).join(ends, "path", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_chars").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )
