"""Verdicts on the URLs of ``pages``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.tables import query, read
from cyclemart.llm.url_filters import UNWANTED_HOSTS, filtered, host_rule

SITE_RULES = (
    host_rule("allow", "com", "/"), host_rule("block", "example.com", "/en/"), host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"), host_rule("block", "net", "/fr/"),
)
#: Site rules go before the others, which stand for the method's own verdict.
RULES = (*[replace(r, weight=1000 + r.weight) for r in SITE_RULES], *UNWANTED_HOSTS)

_CASES = ", ".join(f"('{r.name}', '{r.verdict}', '{r.pattern}', {r.weight})" for r in SITE_RULES)
_WORDS = " OR ".join(f"regexp_matches(host || path, '{r.pattern}')" for r in UNWANTED_HOSTS)

SQL = rf"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule, verdict, pattern, weight) AS (VALUES {_CASES}),
fitting AS (
  SELECT page_id, host, path, max_by(rule, weight) AS rule, max_by(verdict, weight) AS verdict
  FROM parts LEFT JOIN rules ON regexp_matches(host || path, pattern)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {_WORDS} THEN 'block' ELSE 'allow' END) AS verdict FROM fitting
"""


@query("op9_url_filters", SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filtered(read(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return found.select(
        "page_id", "host", "path",
        F.when(F.col("rule").isin([r.name for r in SITE_RULES]), F.col("rule")).alias("rule"),
        F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"),
    )
