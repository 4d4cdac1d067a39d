"""From raw documents to training shards: five stages, each one operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.decontamination import decontaminated
from cyclemart.llm.mixing import taken_rows
from cyclemart.llm.near_duplicates import NearDuplicates, deduplicated
from cyclemart.llm.quality_rules import passing
from cyclemart.llm.ring import Ring, sharded
from cyclemart.llm.tables import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Mixing repeats rows on purpose and dealing documents into shards depends on all of them, in hash order.
ORACLE_SQL = None


def stage(function: Stage) -> Stage:
    """Other columns of the documents travel under names that no operator uses; where a stage adds
    a column of the same name (the last does), its own stays."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        safe = docs.toDF(*[n if n in COLUMNS else f"other_{i}_{n}" for i, n in enumerate(names)])
        found = function(spark, safe, sf_dir)
        back = dict(zip(safe.columns, names, strict=True))
        added = [c for c in found.columns if c not in back]
        kept = [c for c in found.columns if c in added or back[c] not in added]
        return found.select(*kept).toDF(*[back.get(c, c) for c in kept])

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return passing(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word-shingle similarity 0.8."""
    return deduplicated(docs, NearDuplicates(shingle=5, percent=80))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return taken_rows(docs)


@stage
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot."""
    return sharded(docs, Ring(shards=24))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
