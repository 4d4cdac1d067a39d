"""Test items of ``benchmark`` found in ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.decontamination import contaminated_pairs
from cyclemart.llm.tables import query, read


@query("op4_benchmark_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and test item that it holds; clean documents have none."""
    return contaminated_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
