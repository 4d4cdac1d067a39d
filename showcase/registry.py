"""Where queries and their SQL texts are kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.settings import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        @wraps(function)
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            SQL[name] = sql
        return tuned

    return add


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, so results compare across engines that add in another order."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])
