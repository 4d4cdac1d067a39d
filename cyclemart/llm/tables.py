"""Input tables, intermediate tables and the registry of the queries in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cyclemart.operators.staging_area import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the folder that the cluster shares."""
    return materialise(df, label)
