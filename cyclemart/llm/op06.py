"""Main text of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.html_text import extracted
from cyclemart.llm.tables import query, read


@query("op6_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
