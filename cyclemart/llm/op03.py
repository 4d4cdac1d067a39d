"""``documents`` mixed to target weights of their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.mixing import mixed
from cyclemart.llm.tables import query, read


@query("op3_source_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixed(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
