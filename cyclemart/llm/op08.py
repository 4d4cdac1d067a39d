"""Licenses in ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.licenses import license_scan
from cyclemart.llm.tables import query, read


@query("op8_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))
